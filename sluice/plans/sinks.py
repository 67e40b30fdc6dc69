"""Queries that write what they are given, in the shared folder or the warehouse, and return what was read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.operators import arrival as AR
from sluice.operators import drift as DR
from sluice.operators import features as FE
from sluice.operators import models as ML
from sluice.operators import profiles as PR
from sluice.operators import quality as DQ
from sluice.plans.base import query, r4, table
from sluice.plans.streams import events, shared_folder
from sluice.sources import tables as T
from sluice.streaming import streams as ST


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(12, 2)").alias("price"), F.col("o_orderpriority").alias("priority"))


def _table_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"


@query("SELECT o_orderkey, o_custkey, o_totalprice::DECIMAL(12, 2)::DOUBLE AS price FROM orders UNION ALL SELECT o_orderkey, o_custkey, o_totalprice::DECIMAL(12, 2)::DOUBLE FROM orders WHERE o_orderkey % 10 = 0")
def snk_parquet_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK01, SRC02: written, written over, appended to"""
    at, o = shared_folder(spark), _orders(spark, sf_dir)
    T.write(o.where("o_orderkey % 2 = 0"), at)
    T.write(o, at, mode="overwrite")
    T.write(o.where("o_orderkey % 10 = 0"), at, mode="append")
    return T.read(spark, at).select("o_orderkey", "o_custkey", F.col("price").cast("double").alias("price"))


@query("SELECT priority, count(*) AS n FROM (SELECT o_orderpriority AS priority FROM orders) GROUP BY priority")
def snk_managed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK02, SRC03: a managed table, read by its name; the name is free again afterwards, the rows are kept"""
    name, at = _table_name("orders"), shared_folder(spark)
    T.write_table(_orders(spark, sf_dir), name, partition_by=["priority"])
    T.write(T.read_table(spark, name).groupBy("priority").agg(F.count(F.lit(1)).alias("n")), at)
    spark.sql(f"DROP TABLE {name}")
    return T.read(spark, at)


@query("SELECT o_orderkey, o_orderpriority AS priority, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END::BIGINT AS version FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderkey % 2 = 0")
def snk_overwrite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK03: one partition is written anew, the others stay"""
    at, o = shared_folder(spark), _orders(spark, sf_dir).select("o_orderkey", "priority").withColumn("version", F.lit(1).cast("long"))
    T.overwrite_partitions(o, at, ["priority"])
    T.overwrite_partitions(o.where("priority = '1-URGENT' and o_orderkey % 2 = 0").withColumn("version", F.lit(2).cast("long")), at, ["priority"])
    return T.read(spark, at).select("o_orderkey", F.col("priority").cast("string").alias("priority"), "version")


@query("SELECT count(*) AS n_rows, count(*) FILTER (o_orderstatus = 'F') AS n_positive, 'orders' AS job FROM orders")
def snk_run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK04, ML11: one row of JSON"""
    at = shared_folder(spark)
    o = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("o_orderstatus") == "F").alias("n_positive")).withColumn("job", F.lit("orders"))
    T.write(o, at, fmt="json")
    return T.read(spark, at, fmt="json").select("n_rows", "n_positive", "job")


@query("SELECT o_orderkey, o_custkey, o_orderpriority AS priority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def snk_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK05, SNK03: a partitioned table made from a list of columns, two of its partitions filled"""
    name, at = _table_name("catalog"), shared_folder(spark)
    T.create_partitioned_table(spark, name, [("o_orderkey", "bigint"), ("o_custkey", "bigint")], [("priority", "string")])
    o = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "priority")
    for p in ("1-URGENT", "2-HIGH"):
        T.overwrite_partitions(o.where(F.col("priority") == p), name, ["priority"])
    T.write(T.read_table(spark, name), at)
    spark.sql(f"DROP TABLE {name}")
    return T.read(spark, at)


@query("SELECT count(*) AS n, count(*) AS same FROM lineitem WHERE l_quantity < 10")
def snk_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK06, ML10, PRJ17: a fitted model saved, loaded, and scoring as before; rows are told apart by a surrogate id that is
    written with them"""
    at = shared_folder(spark)
    x = table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", (F.col("l_extendedprice") > 50_000).cast("int").alias("label")).where("l_quantity < 10")
    rows = T.materialize(spark, f"{at}/rows", lambda: FE.surrogate_id(x, "row"))
    model = ML.train_forest(rows, ["l_quantity", "l_discount"], "label", trees=2, depth=2)
    ML.save(model, f"{at}/model")
    again: PipelineModel = ML.load(f"{at}/model")
    both = ML.score(rows, model, "row").join(ML.score(rows, again, "row").withColumnRenamed("p", "q").drop("prediction"), "row")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p") == F.col("q")).alias("same"))


@query("SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY ALL")
def snk_materialise_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK07: the second making does not happen"""
    at = shared_folder(spark)
    T.materialize(spark, at, lambda: _orders(spark, sf_dir).groupBy("priority").agg(F.count(F.lit(1)).alias("n")))
    return T.materialize(spark, at, lambda: spark.range(1).select(F.lit("made again").alias("priority"), F.col("id").alias("n")))


@query("SELECT p_partkey::VARCHAR AS p_partkey, coalesce(p_name, '') AS p_name, p_brand FROM part")
def snk_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK08, SRC07: CSV with a header"""
    at = shared_folder(spark)
    T.write(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), at, fmt="csv")
    return T.read(spark, at, fmt="csv", header="true").fillna("", ["p_name"])


@query("SELECT * FROM (VALUES ('p_name', 'ok'), ('p_size', 'ok'), ('p_retailprice', 'type'), ('p_weight', 'missing')) t(\"column\", state), (SELECT count(*) AS n FROM part) u")
def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ06, beside the table's row count"""
    part = table(spark, sf_dir, "part")
    wanted = {"p_name": "string", "p_size": dict(part.dtypes)["p_size"], "p_retailprice": "string", "p_weight": "double"}
    said = DQ.check_schema(part, list(wanted.items()))
    said = dict.fromkeys(said["missing"], "missing") | dict.fromkeys(said["wrong_type"], "type")
    rows = spark.createDataFrame([(c, said.get(c, "ok")) for c in wanted], "column string, state string")
    return rows.crossJoin(part.agg(F.count(F.lit(1)).alias("n")))


@query("SELECT conv_id, list_aggregate(list_sort(list_distinct(list(role))), 'string_agg', ',') AS roles, max(turn)::BIGINT AS last_turn FROM conversations GROUP BY conv_id")
def ag_distinct_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG08: the greatest value, and the distinct values in order"""
    out = FE.distinct_sorted(table(spark, sf_dir, "conversations"), ["conv_id"], "role", "roles").withColumn("roles", F.array_join("roles", ","))
    return out.join(table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max("turn").cast("long").alias("last_turn")), "conv_id")


@query("""WITH b AS (SELECT CASE WHEN o_totalprice <= 100000 THEN 1 WHEN o_totalprice <= 200000 THEN 2 WHEN o_totalprice <= 300000 THEN 3 ELSE 4 END::BIGINT AS bin FROM orders)
SELECT 'o_totalprice' AS variable, bin, count(*) AS n, row_number() OVER (ORDER BY bin) AS place FROM b GROUP BY bin""")
def st_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST04: counts by bin, as an ordered report"""
    b = table(spark, sf_dir, "orders").select(DR.first_bin(F.col("o_totalprice"), [100_000.0, 200_000.0, 300_000.0, 0.0]).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return r4(DR.ordered_report(b.withColumn("variable", F.lit("o_totalprice")), ["variable"], "bin").select("variable", "bin", "n", "place"))


def _days(kind: str, when: str, have: str = "o_orderdate::DATE") -> str:
    return f"""SELECT '{kind}' AS kind, p::VARCHAR AS partition, (SELECT count(*) FROM orders WHERE {have} = p) AS count, (SELECT count(*) FROM orders WHERE {have} = p) > 0 AS arrived
FROM (SELECT {when} AS p FROM (SELECT DATE '2001-12-01' - to_months(i::INT + 1) AS m FROM range(0, 24) t(i)))"""


@query(" UNION ALL ".join([_days("fixed_day", "(m + INTERVAL 14 DAYS)::DATE"), _days("month_start", "m::DATE"), _days("monthly_any", "m::DATE", "date_trunc('month', o_orderdate)::DATE"), "SELECT 'on_demand', NULL, count(*), count(*) > 0 FROM orders"]))
def ar_expected_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR11: days of the month, first days, any day of a month, and tables without periods"""
    o = table(spark, sf_dir, "orders")
    counts = AR.partition_counts(o, "orders", F.col("o_orderdate"))
    each = [AR.expected_partitions(counts, k, "2001-12-31", 24, lag=1, kind=k, day=15) for k in ("fixed_day", "month_start", "monthly_any")]
    out = FE.union_all([*each, AR.on_demand(o, "on_demand")])
    return out.select(F.col("table_name").alias("kind"), F.col("partition").cast("string").alias("partition"), "count", "arrived")


def _ran(spark: SparkSession, sf_dir: str, transform: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int]:
    at = shared_folder(spark)
    q = ST.run_stream(events(spark, sf_dir), transform, f"{at}/out", f"{at}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{at}/out"), ST.dropped_late(q)


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) - i * INTERVAL 1 DAY AS s, event_type FROM events, (VALUES (0), (1)) t(i))
SELECT s::VARCHAR AS window_start, event_type, count(*) AS n FROM w WHERE s + INTERVAL 2 DAYS <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL""")
def str_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR02: windows of two days, one each day"""
    out, _ = _ran(spark, sf_dir, lambda s: ST.windowed(s, "ts", ["event_type"], "value", "2 days", "1 day"))
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


@query("SELECT count(*) AS n, count(*) AS scored FROM events WHERE value IS NOT NULL")
def str_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR06: a model fitted on the events as a table scores them as a stream"""
    x = table(spark, sf_dir, "events").select("event_id", "value", (F.col("event_type") == "purchase").cast("int").alias("label")).where("value is not null")
    model = ML.train_forest(x, ["value"], "label", trees=2, depth=2)
    out, _ = _ran(spark, sf_dir, lambda s: ST.score_stream(s.where("value is not null"), model).select("event_id", "prediction"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.count("prediction").alias("scored"))


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, user_id, count(*) AS n FROM events GROUP BY ALL)
SELECT s::VARCHAR AS window_start, user_id, n, 0::BIGINT AS late FROM w WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def str_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR06, STR07: events per user and hour, with the number of rows that came too late"""
    out, late = _ran(spark, sf_dir, lambda s: ST.windowed(s, "ts", ["user_id"], "value", "1 hour"))
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "user_id", "n", F.lit(late).cast("long").alias("late"))


_HYBRID = """WITH r AS (SELECT o_custkey AS u, l_partkey AS i, avg(1 + l_quantity::BIGINT % 5) AS rating FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 20 = 0 GROUP BY ALL),
c AS (SELECT p_partkey AS i, min(p_partkey) OVER (PARTITION BY p_brand, p_type) AS k FROM part), m AS (SELECT u, k, avg(rating) AS content_score FROM r JOIN c USING (i) GROUP BY ALL)
SELECT u, i, round(0.5 * coalesce(rating, 0) + 0.5 * coalesce(content_score, 0), 4) AS hybrid_score FROM r JOIN c USING (i) LEFT JOIN m USING (u, k)"""


@query(_HYBRID.replace(" WHERE o_custkey % 20 = 0", ""))
def ml_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML13: each rating with the user's mean rating of the item's class"""
    from sluice.plans.relational import ratings

    r = ratings(spark, sf_dir).groupBy("u", "i").agg(F.avg("rating").alias("rating"))
    classes = ML.attribute_class(table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "i"), "i", ["p_brand", "p_type"])
    own = r.join(classes, "i")
    content = own.groupBy("u", "class").agg(F.avg("rating").alias("content_score"))
    return ML.hybrid(r, own.select("u", "i", "class").join(content, ["u", "class"]).drop("class"), ["u", "i"]).select("u", "i", F.round("hybrid_score", 4).alias("hybrid_score"))


@query("SELECT count(*) AS n, 20 * count(*) AS rows, count(*) AS ordered FROM (SELECT DISTINCT l_partkey FROM lineitem)")
def ml_top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML02, ML04: factors chosen by cross-validation among two regularisations; what must hold of the best users of each item"""
    from sluice.plans.relational import ratings

    r = ratings(spark, sf_dir).select(F.col("u").cast("int").alias("u"), F.col("i").cast("int").alias("i"), F.col("rating").cast("float").alias("rating"))
    r = T.stored(r, "ratings")
    top = ML.top_users(ML.train_als(r, "u", "i", "rating", ranks=(4, 5), regs=(0.1, 1.0), iterations=2), "u", "i", 20)
    falls = F.coalesce(F.col("rating") <= F.lag("rating").over(Window.partitionBy("i").orderBy("rank")), F.col("rating").isNotNull())
    each = top.withColumn("falls", falls).groupBy("i").agg(F.count_distinct("u").alias("n"), F.bool_and("falls").alias("falls"))
    return each.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("rows"), F.count_if("falls").alias("ordered"))


@query("""WITH o AS (SELECT o_orderpriority AS priority, o_totalprice FROM orders UNION ALL SELECT o_orderpriority, o_totalprice FROM orders WHERE o_orderkey % 10 = 0)
SELECT priority, count(*) AS n, 3::BIGINT AS made FROM o GROUP BY priority""")
def snk_materialise_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK07: made once, read while nothing changes, made again when the input has more rows and when the code is another"""
    at, o, made = shared_folder(spark), _orders(spark, sf_dir), []
    T.write(o, f"{at}/in")

    def step(version: str) -> DataFrame:
        make = lambda: made.append(1) or T.read(spark, f"{at}/in").groupBy("priority").agg(F.count(F.lit(1)).alias("n"))
        return T.materialize(spark, f"{at}/out", make, inputs=[f"{at}/in"], version=version)

    step("1")
    step("1")
    T.write(o.where("o_orderkey % 10 = 0"), f"{at}/in", mode="append")
    step("1")
    return step("2").select("priority", "n", F.lit(len(made)).cast("long").alias("made"))


_PROFILED = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"]


@query("""WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS o_orderstatus FROM orders)
""" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS total, count(*) - count({c}) AS nulls, " + (f"round(avg({c}), 2) AS mean, round(stddev({c}), 2) AS stddev, round(min({c}), 2)::DOUBLE::VARCHAR AS min, " if c in ("o_orderkey", "o_custkey", "o_totalprice") else f"NULL::DOUBLE, NULL::DOUBLE, min({c}), ") + "true AS distinct_ok, true AS percentiles_ok FROM o" for c in _PROFILED))
def dq_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ10, DR04: the years' states, the last one added later, merged. The sketches are held against exact figures: distinct values
    within 2 %, ranks of percentiles within 1 %"""
    o = table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")))
    at, year = shared_folder(spark), F.year("o_orderdate")
    last = F.year(F.lit("1998-01-01").cast("date"))
    PR.store_states(PR.profile_states(o.where(year < last), year, _PROFILED), at)
    PR.store_states(PR.profile_states(o.where(year >= last), year, _PROFILED), at)
    found = PR.merged_profile(PR.stored_states(spark, at))
    exact = o.agg(*(F.count_distinct(c).alias(c) for c in _PROFILED)).unpivot([], _PROFILED, "column", "exact")
    marks = found.where("p50 is not null").select("column", F.explode(F.array(*(F.struct(F.lit(p / 100).alias("p"), F.col(f"p{p}").alias("x")) for p in DR.PERCENTS))).alias("m")).select("column", "m.*")
    values = o.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in _PROFILED[:3]))))
    ranks = values.join(F.broadcast(marks), "column").groupBy("column", "p").agg(F.avg((F.col("v") < F.col("x")).cast("int")).alias("lo"), F.avg((F.col("v") <= F.col("x")).cast("int")).alias("hi"))
    ranks = ranks.groupBy("column").agg(F.bool_and((F.col("lo") <= F.col("p") + 0.01) & (F.col("hi") >= F.col("p") - 0.01)).alias("percentiles_ok"))
    out = found.join(exact, "column").join(ranks, "column", "left")
    number = F.col("p50").isNotNull()
    low = F.when(number, F.round(F.col("min").cast("double"), 2).cast("string"))
    return out.select("column", "total", "nulls", F.round("mean", 2).alias("mean"), F.round("stddev", 2).alias("stddev"), F.coalesce(low, F.col("min")).alias("min"), (F.abs(F.col("distinct") - F.col("exact")) <= 0.02 * F.col("exact")).alias("distinct_ok"), F.coalesce("percentiles_ok", F.lit(True)).alias("percentiles_ok"))
