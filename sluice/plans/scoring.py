"""Queries of score publishing, experiments, metric tables and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.operators import features as FE
from sluice.operators import models as ML
from sluice.operators import scores as SP
from sluice.operators.ranks import curve_areas
from sluice.plans.base import query, r4, table
from sluice.plans.monitoring import _CONF, _PRED, actuals, predictions
from sluice.plans.relational import _RATINGS, ratings
from sluice.sources import tables as T


@query("SELECT o_orderkey, ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS quartile, ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS decile FROM orders")
def wn_global_ntile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN07, SP03"""
    return r4(SP.global_ntile(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", {"quartile": 4, "decile": 10}).drop("o_totalprice"))


MINS, MAXS = [-1000.0 + 1000 * k for k in range(10)], [1000.0 * k for k in range(10)]


def _scores(spark: SparkSession, sf_dir: str, name: str = "risk") -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("d", F.lit("2001-07-31 00:00:00").cast("timestamp"))
    return SP.assign_decile(SP.normalise_scores(c, "c_custkey", "c_acctbal", "d", "2001-08-01 00:00:00", name), "score", MINS, MAXS)


_DEC = "CASE " + " ".join(f"WHEN c_acctbal BETWEEN {lo} AND {hi} THEN {k}" for k, (lo, hi) in enumerate(zip(MINS, MAXS, strict=True), 1)) + " ELSE 0 END"
_SCORED = f"""WITH s AS (SELECT c_custkey AS customer_id, round(c_acctbal, 4) AS score, '2001-07-31T00:00:00Z' AS score_info_dt, '2001-08-01T00:00:00Z' AS score_process_dt, 'risk' AS score_name, {_DEC} AS decile FROM customer),
q AS (SELECT *, CASE WHEN decile BETWEEN 1 AND 2 THEN 1 WHEN decile BETWEEN 3 AND 5 THEN 2 WHEN decile BETWEEN 6 AND 8 THEN 3 WHEN decile BETWEEN 9 AND 10 THEN 4 ELSE 0 END AS quartile FROM s) """


@query(_SCORED + "SELECT customer_id, score, score_info_dt, score_process_dt, score_name, decile::BIGINT AS decile, quartile::BIGINT AS quartile FROM q")
def sp_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SP01, SP02"""
    return r4(_scores(spark, sf_dir))


_DOC = """'{"credit_approved_dt":{"$date":"2001-08-01T00:00:00Z"},"credit_approved_flag":true,"credit_score_decile_val":' || decile || ',"credit_score_quartile_val":' || quartile || ',"score":{"$numberDecimal":"' || score::VARCHAR || '"},"score_info_dt":{"$date":"2001-07-31T00:00:00Z"},"score_name":"risk","score_process_dt":{"$date":"2001-08-01T00:00:00Z"}}'"""


@query(_SCORED + f"SELECT customer_id, {_DOC} AS risk_score FROM q")
def sp_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SP04"""
    return SP.score_documents(_scores(spark, sf_dir))


_SEG = """'{"segment_name":"' || c_mktsegment || '","segment_dt":{"$date":"2001-08-01T00:00:00Z"}}'"""


@query(_SCORED + f"SELECT 3::BIGINT AS model_type_execution, customer_id, ({_DOC}) || '|' || ({_DOC}) AS risk_scores, {_SEG} AS customer_segments FROM q JOIN customer ON c_custkey = customer_id")
def sp_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SP04-SP06"""
    docs = SP.score_documents(_scores(spark, sf_dir))
    seg = SP.segment_documents(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "customer_id"), "2001-08-01 00:00:00", "c_mktsegment")
    out = SP.publish([docs, docs], seg, 3)
    return r4(out.withColumns({"risk_scores": F.array_join("risk_scores", "|"), "customer_segments": F.array_join("customer_segments", "|")}))


_MD5 = "(('0x' || substr(md5(user_id::VARCHAR), 1, 16))::UBIGINT::HUGEINT % 1000 * 616 + ('0x' || substr(md5(user_id::VARCHAR), 17, 16))::UBIGINT::HUGEINT) % 1000"
_ARMS = f"WITH e AS (SELECT *, CASE WHEN {_MD5} < 400 THEN 'treatment' ELSE 'control' END AS arm FROM events) "


def _arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SP.assign_arms(table(spark, sf_dir, "events"), "user_id", 0.4)


@query(_ARMS + "SELECT DISTINCT user_id, arm FROM e")
def ab_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AB01"""
    return _arms(spark, sf_dir).select("user_id", "arm").distinct()


def _ab(value: str, se: str) -> str:
    own = "sqrt(vt / nt + vc / nc)"
    return f""", g AS (SELECT count({value}) FILTER (arm = 'treatment') AS nt, count({value}) FILTER (arm = 'control') AS nc, avg({value}) FILTER (arm = 'treatment') AS mt, avg({value}) FILTER (arm = 'control') AS mc,
  var_samp({value}) FILTER (arm = 'treatment') AS vt, var_samp({value}) FILTER (arm = 'control') AS vc FROM e), z AS (SELECT *, (mt - mc) / {se} AS z FROM g)
SELECT nt AS n_treatment, nc AS n_control, round(mt, 4) AS mean_treatment, round(mc, 4) AS mean_control, round(mt - mc, 4) AS difference, round((mt - mc) / mc, 4) AS lift, round(z, 4) AS z, round(mt - mc - 1.959963984540054 * {own}, 4) AS ci_low,
  round(mt - mc + 1.959963984540054 * {own}, 4) AS ci_high, abs(z) > 1.959963984540054 AS significant,
  CASE WHEN nt < 1000 OR nc < 1000 THEN 'insufficient_data' WHEN abs(z) <= 1.959963984540054 THEN 'no_difference' WHEN mt > mc THEN 'adopt_treatment' ELSE 'keep_control' END AS recommendation FROM z"""


@query(_ARMS + _ab("value", "sqrt(vt / nt + vc / nc)"))
def ab_compare_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AB02"""
    return r4(SP.compare_arms(_arms(spark, sf_dir), "value"))


@query(_ARMS.replace("SELECT *,", "SELECT *, (event_type = 'purchase')::DOUBLE AS bought,") + _ab("bought", "sqrt((mt * nt + mc * nc) / (nt + nc) * (1 - (mt * nt + mc * nc) / (nt + nc)) * (1 / nt + 1 / nc))"))
def ab_compare_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AB02"""
    return r4(SP.compare_arms(_arms(spark, sf_dir).withColumn("bought", (F.col("event_type") == "purchase").cast("double")), "bought", kind="rate"))


@query("SELECT event_type, user_id, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def mt_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT01"""
    return SP.counter_totals(table(spark, sf_dir, "events"), "event_type", ["user_id"], "value").withColumn("total", F.round("total", 2))


@query("SELECT event_type, user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL")
def mt_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT02, WN10"""
    return SP.gauge_latest(table(spark, sf_dir, "events"), "event_type", ["user_id"], "value", "ts", "event_id").drop("ts")


@query("SELECT event_type, n AS total_count, round(s, 2) AS total_sum, replace(b::VARCHAR, 'inf', 'Infinity') AS upper_bound, (SELECT count(*) FROM events e WHERE e.event_type = g.event_type AND e.value <= b) AS cumulative FROM (SELECT event_type, count(value) AS n, sum(value) AS s FROM events GROUP BY 1) g, (VALUES (0.1::DOUBLE), (0.5), (1.0), (5.0), (10.0), (30.0), (60.0), (300.0), (600.0), (1800.0), (3600.0), ('Infinity'::DOUBLE)) t(b)")
def mt_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT03"""
    out = SP.histogram_buckets(table(spark, sf_dir, "events"), "event_type", "value")
    return out.withColumns({"total_sum": F.round("total_sum", 2), "upper_bound": F.col("upper_bound").cast("string")})


@query("SELECT time_bucket(INTERVAL 5 MINUTES, ts)::VARCHAR AS window_start, count(*) AS n, count(*) FILTER (event_type = 'error') AS failures, round(count(*) FILTER (event_type = 'error') / count(*), 4) AS rate FROM events GROUP BY 1 HAVING count(*) FILTER (event_type = 'error') / count(*) > 0.1")
def mt_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT04"""
    return r4(SP.alerts(table(spark, sf_dir, "events"), "ts", F.col("event_type") == "error").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")))


@query(_PRED + _CONF + " FROM c")
def ml_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML06, AG11"""
    return r4(ML.confusion(predictions(spark, sf_dir).join(actuals(spark, sf_dir), "o_orderkey"), "label", "prediction"))


@query("""WITH r AS (SELECT (o_orderstatus = 'F')::INT AS y, rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS k FROM orders)
SELECT round((sum(k) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6) AS auc FROM r""")
def ml_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML06"""
    return r4(ML.auc(predictions(spark, sf_dir).join(actuals(spark, sf_dir), "o_orderkey"), "label", "value"), 6)


@query("""WITH d AS (SELECT o_totalprice AS v, count(*) FILTER (o_orderstatus = 'F') AS pos, count(*) FILTER (o_orderstatus <> 'F') AS neg FROM orders GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY v DESC) AS tp, sum(neg) OVER (ORDER BY v DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM d)
SELECT round(sum(pos * (n - fp + neg / 2)) / max(p * n), 6) AS auc, round(sum(pos / p * (tp / (tp + fp) + CASE WHEN tp + fp = pos + neg THEN tp / (tp + fp) ELSE (tp - pos) / (tp + fp - pos - neg) END) / 2), 6) AS auc_pr FROM c""")
def ml_curve_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML06: both areas"""
    return r4(curve_areas(predictions(spark, sf_dir).join(actuals(spark, sf_dir), "o_orderkey"), "label", "value"), 6)


@query("SELECT round(sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2)), 2) AS rmse, round(avg(abs(l_extendedprice - l_quantity * 1500)), 2) AS mae FROM lineitem")
def ml_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML07"""
    x = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") * 1500).alias("p"), "l_extendedprice")
    return r4(ML.regression_metrics(x, "l_extendedprice", "p"), 2)


_RECS = _RATINGS + """, best AS (SELECT i, row_number() OVER (PARTITION BY 1 ORDER BY count(*) DESC, i) AS k FROM r GROUP BY i), recs AS (SELECT DISTINCT u, b.i FROM r JOIN best b ON b.k <= 5 AND u % 5 = b.k - 1), rel AS (SELECT DISTINCT u, i FROM r WHERE rating >= 4) """


@query(_RECS + """SELECT round((SELECT count(DISTINCT u) FROM recs) / (SELECT count(DISTINCT u) FROM r), 4) AS user_coverage, round((SELECT count(DISTINCT i) FROM recs) / (SELECT count(DISTINCT i) FROM r), 6) AS item_coverage,
  round((SELECT count(*) FROM recs) / (SELECT count(DISTINCT u) FROM recs), 4) AS avg_per_user, round((SELECT count(*) FROM recs JOIN rel USING (u, i)) / (SELECT count(*) FROM recs), 4) AS precision""")
def ml_recommendation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML08, JN06: of the five most frequent items, one for each fifth of the users"""
    r = ratings(spark, sf_dir)
    best = r.groupBy("i").count().orderBy(F.desc("count"), "i").limit(5)
    best = best.select("i", F.expr("row_number() over (order by count desc, i) - 1").alias("k"))
    recs = r.select("u").distinct().withColumn("k", (F.col("u") % 5).cast("int")).join(F.broadcast(best), "k").select("u", "i")
    out = ML.recommendation_metrics(recs, r, "u", "i", "rating")
    return out.select(F.round("user_coverage", 4).alias("user_coverage"), F.round("item_coverage", 6).alias("item_coverage"), F.round("avg_per_user", 4).alias("avg_per_user"), F.round("precision", 4).alias("precision"))


@query(_RATINGS + """, s AS (SELECT DISTINCT u, i FROM r), n AS (SELECT i, count(*) AS n FROM s GROUP BY i), p AS (SELECT a.i AS item_a, b.i AS item_b, count(*) AS common FROM s a JOIN s b ON a.u = b.u AND a.i < b.i GROUP BY ALL)
SELECT item_a, item_b, common, round(common / sqrt(x.n * y.n), 4) AS similarity FROM p JOIN n x ON x.i = item_a JOIN n y ON y.i = item_b WHERE common / sqrt(x.n * y.n) >= 0.12""")
def ml_similar_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML04"""
    return r4(ML.similar_items(ratings(spark, sf_dir), "u", "i", least=0.12))


@query("""WITH k AS (SELECT p_brand, p_type, min(p_partkey) AS c FROM part GROUP BY ALL), j AS (SELECT a.c AS class_a, b.c AS class_b, ((a.p_brand = b.p_brand)::INT + (a.p_type = b.p_type)::INT) AS m FROM k a, k b)
SELECT class_a, class_b, round(m / (4 - m), 4) AS similarity FROM j WHERE m / (4 - m) >= 0.3""")
def ml_content_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML13"""
    return r4(ML.content_similarity(table(spark, sf_dir, "part"), "p_partkey", ["p_brand", "p_type"], 0.3))


@query("""WITH s AS (SELECT DISTINCT o_custkey AS c, date_trunc('month', o_orderdate) AS m FROM orders), n AS (SELECT c, count(*) AS n FROM s GROUP BY c), p AS (SELECT a.c AS item_a, b.c AS item_b, count(*) AS common FROM s a JOIN s b ON a.m = b.m AND a.c < b.c GROUP BY ALL)
SELECT item_a, item_b, common, round(common / sqrt(x.n * y.n), 4) AS similarity FROM p JOIN n x ON x.c = item_a JOIN n y ON y.c = item_b WHERE common / sqrt(x.n * y.n) >= 0.55""")
def ml_similar_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML04: customers who buy in the same months"""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.trunc("o_orderdate", "MM").alias("month"))
    return r4(ML.similar_items(o, "month", "o_custkey", least=0.55))


@query("""WITH k AS (SELECT p_brand, p_type, p_size, min(p_partkey) AS c FROM part GROUP BY ALL), j AS (SELECT a.c AS class_a, b.c AS class_b, ((a.p_brand = b.p_brand)::INT + (a.p_type = b.p_type)::INT + (a.p_size = b.p_size)::INT) AS m FROM k a, k b)
SELECT class_a, class_b, round(m / (6 - m), 4) AS similarity FROM j WHERE m / (6 - m) >= 0.5""")
def ml_content_two_of_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML13: classes of three attributes that share two"""
    return r4(ML.content_similarity(table(spark, sf_dir, "part"), "p_partkey", ["p_brand", "p_type", "p_size"], 0.5))


@query("SELECT count(*) AS n_rows, count(*) FILTER (o_orderstatus = 'F') AS n_positive, round(avg((o_orderstatus = 'F')::INT), 4) AS positive_rate FROM orders")
def ml_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML11"""
    return r4(ML.run_summary(actuals(spark, sf_dir), "label"))


@query()
def ml_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML02, ML03, ST02"""
    r = FE.frequent_only(ratings(spark, sf_dir), "u", "i", 5, 5).select(F.col("u").cast("int").alias("u"), F.col("i").cast("int").alias("i"), F.col("rating").cast("float").alias("rating"))
    return ML.recommend(ML.train_als(r, "u", "i", "rating"), "u", "i", 5, "2002-01-01")


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", (F.col("l_extendedprice") > 50_000).cast("int").alias("label"))
    return FE.hash_split(x, "l_orderkey")


@query()
def ml_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML01, ML10, ML12, PL04: trained on the training part, both models' mean probability on the test part"""
    x = _training(spark, sf_dir)
    train, test = x.where("not is_test"), x.where("is_test").withColumn("row", F.concat_ws(":", "l_orderkey", "l_linenumber"))
    names = ["l_quantity", "l_discount"]
    models = {"boosted": ML.train_classifier(train, names, "label", depths=(2, 3), folds=2), "forest": ML.train_forest(train, names, "label", trees=5)}
    return ML.score_all(test, models, ["row"], "p").select("row", "p")


@query()
def ml_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML09"""
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    return ML.feature_importance(ML.train_forest(_training(spark, sf_dir), names, "label", trees=5), names)


@query()
def ml_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML05"""
    return ML.cluster(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"], k=8).select("p_partkey", "cluster")


_TRUTH = "l_quantity * (1 - l_discount) > 24"
_TEST = f"md5(l_orderkey::VARCHAR) < '{FE.share_bound(0.2)}'"


@query(f"""WITH t AS (SELECT count(*) AS n FROM lineitem WHERE {_TEST}) SELECT m.*, n FROM t, (VALUES ('boosted', 1, true), ('forest', 1, true), ('ensemble', 1, true), ('saved', 1, true), ('l_quantity', 1, true), ('l_discount', 2, true), ('importance adds up', 0, true)) m(subject, place, holds)""")
def ml_models_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML01, ML09, ML10, ML12, SNK06: what must hold of models that have learned: on rows kept out of the fit, areas of 0.97 or more; the
    model that was saved and read again scores as before; the label's two columns are the most important of three, in order"""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax", F.expr(_TRUTH).cast("int").alias("label"))
    x = T.stored(FE.hash_split(x, "l_orderkey"), "training")
    train, test, names = x.where("not is_test"), x.where("is_test"), ["l_quantity", "l_discount", "l_tax"]
    models = {"boosted": ML.train_classifier(train, names, "label", depths=(2, 4), iterations=(5,), steps=(0.1, 0.3), folds=2), "forest": ML.train_forest(train, names, "label", trees=8)}
    at = T.shared_folder(spark, "model")
    ML.save(models["boosted"], at)
    scored = T.stored(ML.score_all(test, models | {"saved": ML.load(at)}, ["label"], None).withColumn("ensemble", (F.col("boosted") + F.col("forest")) / 2), "scored")
    n = scored.count()
    areas = {m: ML.auc(scored, "label", m).first()["auc"] for m in ("boosted", "forest", "ensemble", "saved")}
    same = scored.where("saved <> boosted").count() == 0
    rows = [(m, 1, a >= 0.97 and (m != "saved" or same), n) for m, a in areas.items()]
    weights = ML.feature_importance(models["boosted"], names).collect()
    rows += [(w.feature, k, w.importance > 0.001, n) for k, w in enumerate(weights[:2], 1)]
    rows.append(("importance adds up", 0, abs(sum(w.importance for w in weights) - 1) < 1e-9, n))
    return spark.createDataFrame(rows, "subject string, place long, holds boolean, n long")


@query(_RATINGS + """, f AS (SELECT u, i FROM r WHERE u IN (SELECT u FROM r GROUP BY u HAVING count(*) >= 5) AND i IN (SELECT i FROM r GROUP BY i HAVING count(*) >= 5))
SELECT count(DISTINCT u) AS users, 5 * count(DISTINCT u) AS rows, count(DISTINCT u) AS ordered, count(DISTINCT u) AS of_known_items, true AS fits FROM f""")
def ml_recommend_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML02, ML03, ST02, PRJ11: five items for every user, ranks 1 to 5 with ratings that never rise, all different and known; and the
    factors explain the ratings they were fitted on far better than their mean does"""
    r = FE.frequent_only(ratings(spark, sf_dir), "u", "i", 5, 5).select(F.col("u").cast("int").alias("u"), F.col("i").cast("int").alias("i"), F.col("rating").cast("float").alias("rating"))
    r = T.stored(r, "ratings")
    model = ML.train_als(r, "u", "i", "rating", ranks=(10,), regs=(0.05, 0.1), iterations=(4, 6))
    recs = T.stored(ML.recommend(model, "u", "i", 5, "2002-01-01").join(r.select("i", F.lit(1).alias("known")).distinct(), "i", "left"), "recommended")
    falls = F.coalesce(F.col("rating") <= F.lag("rating").over(Window.partitionBy("u").orderBy("rank")), F.lit(True))
    each = recs.withColumn("falls", falls).groupBy("u").agg(F.count(F.lit(1)).alias("n"), (F.bool_and("falls") & (F.min("rank") == 1) & (F.max("rank") == F.count(F.lit(1)))).alias("ordered"), (F.count_distinct("i") == F.count("known")).alias("known"))
    fit = ML.regression_metrics(model.transform(r), "rating", "prediction").join(r.agg(F.stddev("rating").alias("sd"))).select((F.col("rmse") < 0.8 * F.col("sd")).alias("fits"))
    return each.agg(F.count(F.lit(1)).alias("users"), F.sum("n").alias("rows"), F.count_if("ordered").alias("ordered"), F.count_if("known").alias("of_known_items")).join(fit)


@query("SELECT count(*) AS n, 8::BIGINT AS clusters, true AS tight, true AS nearest FROM part")
def ml_cluster_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML05: eight clusters, within which the squared distances are less than a fifth of those from the common mean, and nearly
    every row is nearer to its own cluster's mean than to any other"""
    p = T.stored(ML.cluster(ML.standardise(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"]), ["p_size_scaled", "p_retailprice_scaled"], k=8), "clusters")
    means = p.groupBy("cluster").agg(F.avg("p_size_scaled").alias("x"), F.avg("p_retailprice_scaled").alias("y"))
    d = p.join(F.broadcast(means.withColumnRenamed("cluster", "to"))).withColumn("d", (F.col("p_size_scaled") - F.col("x")) ** 2 + (F.col("p_retailprice_scaled") - F.col("y")) ** 2)
    each = d.groupBy("p_partkey", "cluster", "p_size_scaled", "p_retailprice_scaled").agg(F.min_by("to", "d").alias("to"), F.min(F.when(F.col("to") == F.col("cluster"), F.col("d"))).alias("own"))
    total = F.sum(F.col("p_size_scaled") ** 2 + F.col("p_retailprice_scaled") ** 2)
    return each.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("cluster").alias("clusters"), (F.sum("own") < 0.2 * total).alias("tight"), (F.avg((F.col("to") == F.col("cluster")).cast("int")) > 0.97).alias("nearest"))
