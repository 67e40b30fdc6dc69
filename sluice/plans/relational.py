"""Queries of sources, reshaping, joins, aggregates, windows and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import expressions as X
from sluice.operators import features as FE
from sluice.operators import models as ML
from sluice.operators.months import cohort_windows
from sluice.plans.base import query, r4, table
from sluice.sources import tables as T


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN01: order lines with their customer; the label is a returned line."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left").select("l_orderkey", "o_custkey", "l_suppkey", "l_extendedprice", "o_orderdate", (F.col("l_returnflag") == "R").cast("int").alias("label"))


_W = "PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN INTERVAL {} PRECEDING AND CURRENT ROW"


@query(f"""
WITH t AS (SELECT l_orderkey, o_custkey, l_suppkey, l_extendedprice::DECIMAL(12, 2) AS x, o_orderdate, (l_returnflag = 'R')::INT AS label FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
f AS (SELECT *,
  count(x) OVER ({_W.format("7 DAYS")}) AS c7, sum(x) OVER ({_W.format("7 DAYS")}) AS s7, sum(x) OVER ({_W.format("7 DAYS")})::DOUBLE / count(x) OVER ({_W.format("7 DAYS")}) AS a7, stddev(x::DOUBLE) OVER ({_W.format("7 DAYS")}) AS d7,
  count(x) OVER ({_W.format("1 DAY")}) AS c1, sum(x) OVER (PARTITION BY o_custkey)::DOUBLE / count(x) OVER (PARTITION BY o_custkey) AS ca, min(o_orderdate) OVER (PARTITION BY o_custkey) AS first,
  avg(label) OVER (PARTITION BY l_suppkey) AS mr, count(*) OVER (PARTITION BY l_suppkey) AS mc FROM t)
SELECT l_orderkey, o_custkey, l_suppkey, x::DOUBLE AS amount, c7 AS count_7d, s7::DOUBLE AS sum_7d, a7 AS avg_7d, c1 AS count_24h, ca AS customer_avg,
  date_diff('day', first, o_orderdate) AS days_since_first, round(mr, 4) AS merchant_rate, mc AS merchant_count, dayofweek(o_orderdate) + 1 AS day_of_week, (dayofweek(o_orderdate) IN (0, 6))::BIGINT AS is_weekend,
  CASE WHEN x < 50 THEN 'small' WHEN x < 500 THEN 'medium' WHEN x < 2000 THEN 'large' ELSE 'very_large' END AS amount_class,
  round(CASE WHEN d7 > 0 THEN (x::DOUBLE - a7) / d7 ELSE 0 END, 3) + 0.0 AS z_score
FROM f
""")
def fe_transaction_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE01, WN02-WN05, PRJ04, JN01"""
    tx = transactions(spark, sf_dir).withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(12, 2)"))  # sums are exact
    f = FE.transaction_features(tx, "o_custkey", "l_suppkey", "l_extendedprice", "o_orderdate", "l_orderkey", "label")
    return f.select(
        "l_orderkey", "o_custkey", "l_suppkey", F.col("l_extendedprice").cast("double").alias("amount"), "count_7d", F.col("sum_7d").cast("double").alias("sum_7d"), "avg_7d", "count_24h", "customer_avg",
        F.col("days_since_first").cast("long").alias("days_since_first"), F.round("merchant_rate", 4).alias("merchant_rate"), "merchant_count", F.col("day_of_week").cast("long").alias("day_of_week"), F.col("is_weekend").cast("long").alias("is_weekend"), "amount_class", (F.round("z_score", 3) + F.lit(0.0)).alias("z_score"),
    )


_ALL = {"7d": "7 DAYS", "24h": "1 DAY", "1h": "1 HOUR"}


@query("WITH t AS (SELECT event_id, user_id, event_type, ts, value::DECIMAL(12, 2) AS x FROM events) SELECT event_id, " + ", ".join(f"count(x) OVER w{n} AS count_{n}, (sum(x) OVER w{n})::DOUBLE AS sum_{n}, (sum(x) OVER w{n})::DOUBLE / count(x) OVER w{n} AS avg_{n}, round(stddev(x::DOUBLE) OVER w{n}, 4) AS std_{n}" for n in _ALL) + ", hour(ts) AS hour FROM t WINDOW " + ", ".join(f"w{n} AS (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000000 RANGE BETWEEN {s} PRECEDING AND CURRENT ROW)" for n, s in (("7d", 604_800), ("24h", 86_400), ("1h", 3_600))))
def fe_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE01, WN02: all windows of events by the second, with their deviations"""
    e = table(spark, sf_dir, "events").withColumns({"value": F.col("value").cast("decimal(12, 2)"), "label": F.lit(0)})
    f = FE.transaction_features(e, "user_id", "event_type", "value", "ts", "event_id", "label")
    return f.select("event_id", *(F.col(f"count_{n}") if c == "count" else (F.round(f"std_{n}", 4) + F.lit(0.0)).alias(f"std_{n}") if c == "std" else F.col(f"{c}_{n}").cast("double").alias(f"{c}_{n}") for n in _ALL for c in ("count", "sum", "avg", "std")), F.col("hour").cast("long").alias("hour"))


@query("""
SELECT o_orderkey, count(o_totalprice) OVER w AS count_1h, (sum(o_totalprice::DECIMAL(12, 2)) OVER w)::DOUBLE AS sum_1h, (sum(o_totalprice::DECIMAL(12, 2)) OVER w)::DOUBLE / count(o_totalprice) OVER w AS avg_1h FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 60 PRECEDING AND CURRENT ROW)
""")
def wn_row_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN01"""
    o = table(spark, sf_dir, "orders").withColumns({"label": F.lit(0), "o_totalprice": F.col("o_totalprice").cast("decimal(12, 2)")})
    f = FE.transaction_features(o, "o_custkey", "o_orderpriority", "o_totalprice", "o_orderdate", "o_orderkey", "label", frame="rows")
    return f.select("o_orderkey", "count_1h", F.col("sum_1h").cast("double").alias("sum_1h"), "avg_1h")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def src_latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC01, SRC02, SRC04"""
    return T.latest_partition(T.read(spark, f"{sf_dir}/orders.parquet"), "o_orderdate").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE = DATE '1998-03-15' - INTERVAL 2 MONTHS")
def src_partition_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC05"""
    return T.partition_at(table(spark, sf_dir, "orders"), "o_orderdate", "1998-03-15", 2).select("o_orderkey")


@query("""
SELECT o_orderpriority, k AS code, count(*) AS n FROM orders LEFT JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('5-LOW', 5)) AS x(p, k) ON o_orderpriority = p GROUP BY ALL
""")
def src_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC08, JN07, AG02"""
    codes = T.lookup(spark, [("1-URGENT", 1), ("2-HIGH", 2), ("5-LOW", 5)], "o_orderpriority string, code int")
    return r4(table(spark, sf_dir, "orders").join(F.broadcast(codes), "o_orderpriority", "left").groupBy("o_orderpriority", "code").agg(F.count(F.lit(1)).alias("n")))


@query("""WITH r AS (SELECT c_custkey AS customer_id, unnest(range(1, 11)) AS k FROM customer), f AS (SELECT *, ((('0x' || substr(md5('fraud:' || customer_id || ':' || k), 1, 12))::BIGINT % 10000) < 200)::BIGINT AS is_fraud FROM r)
SELECT 'txn_' || customer_id || '_' || k AS transaction_id, customer_id, 'm_' || (('0x' || substr(md5('merchant:' || customer_id || ':' || k), 1, 12))::BIGINT % 1000) AS merchant_id,
  round(CASE WHEN is_fraud = 1 THEN 1000 + (('0x' || substr(md5('amount:' || customer_id || ':' || k), 1, 12))::BIGINT % 900001) / 100 ELSE 5 + (('0x' || substr(md5('amount:' || customer_id || ':' || k), 1, 12))::BIGINT % 49501) / 100 END, 2) AS amount,
  CASE WHEN is_fraud = 1 THEN ['online', 'atm'][1 + (('0x' || substr(md5('kind:' || customer_id || ':' || k), 1, 12))::BIGINT % 1073741824) % 2] ELSE ['grocery', 'gas', 'restaurant', 'retail', 'online', 'atm'][1 + (('0x' || substr(md5('kind:' || customer_id || ':' || k), 1, 12))::BIGINT % 1073741824) % 6] END AS merchant_category, is_fraud FROM f""")
def src_synthetic_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC09"""
    out = T.synthetic_transactions(table(spark, sf_dir, "customer"), "c_custkey")
    return out.withColumn("is_fraud", F.col("is_fraud").cast("long"))


@query("SELECT p_partkey::VARCHAR AS key, try_cast(p_size AS INT)::BIGINT AS size, try_cast(p_retailprice AS DOUBLE) AS price, try_cast(p_name AS INT)::BIGINT AS bad, 1::BIGINT AS rejected FROM part")
def cat_cast_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAT06, PRJ01"""
    raw = table(spark, sf_dir, "part").select(*(F.col(c).cast("string").alias(n) for c, n in (("p_partkey", "key"), ("p_size", "size"), ("p_retailprice", "price"), ("p_name", "bad"))))
    return r4(T.cast_by_metadata(raw, [("key", "Char", "$6.00"), ("size", "Num", "8.0"), ("price", "Num", "12.2"), ("bad", "Num", "8.0")]).withColumnRenamed("_rejected", "rejected"))


@query("SELECT c_custkey::VARCHAR AS customer_id, round(c_acctbal, 2) AS balance, c_mktsegment AS segment, 'retail' AS line FROM customer")
def prj_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ01, PRJ02, PRJ03"""
    out = T.conform(table(spark, sf_dir, "customer"), [("customer_id", "string"), ("balance", "double"), ("segment", "string"), ("line", "string")], {"c_custkey": "customer_id", "c_acctbal": "balance", "c_mktsegment": "segment"}, {"line": F.lit("retail")})
    return out.withColumn("balance", F.round("balance", 2))


@query("SELECT p_partkey, unnest(['p_size', 'p_retailprice']) AS variable, unnest([p_size::DOUBLE, round(p_retailprice, 4)]) AS value FROM part")
def prj_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ10, PRJ12"""
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), F.round("p_retailprice", 4).alias("p_retailprice"))
    return FE.melt(p, ["p_partkey"], FE.columns_like(p, dtype="double", prefix="p_"))


@query("SELECT vec_id, round(embedding[1]::DOUBLE, 4) AS f1, round(embedding[2]::DOUBLE, 4) AS f2, round(embedding[len(embedding)]::DOUBLE, 4) AS f_last, len(embedding) AS n FROM embeddings")
def prj_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ13, AG14: vectors from their text form"""
    text = table(spark, sf_dir, "embeddings").select("vec_id", F.concat(F.lit("["), F.array_join(F.col("embedding").cast("array<string>"), ","), F.lit("]")).alias("v"))
    v = text.select("vec_id", X.parse_vector(F.col("v")).alias("a"))
    return r4(v.select("vec_id", F.get("a", 0).alias("f1"), F.get("a", 1).alias("f2"), F.get("a", F.size("a") - 1).alias("f_last"), F.size("a").alias("n")))


@query(f"SELECT o_orderkey, md5(o_orderkey::VARCHAR) < '{FE.share_bound(0.2)}' AS is_test FROM orders")
def prj_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ16"""
    return FE.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query(f"SELECT o_orderkey FROM orders WHERE md5(o_orderkey::VARCHAR) < '{FE.share_bound(0.1)}'")
def prj_hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ14"""
    return FE.hash_sample(table(spark, sf_dir, "orders"), "o_orderkey", 0.1).select("o_orderkey")


@query(f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE md5(l_orderkey || ':' || l_linenumber) < '{FE.share_bound(0.0005)}'")
def prj_hash_sample_thin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ14: five rows in ten thousand"""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws(":", "l_orderkey", "l_linenumber").alias("key"))
    return FE.hash_sample(x, "key", 0.0005).drop("key")


_BALANCED = """, n AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM o), z AS (SELECT *, row_number() OVER (ORDER BY d) - 1 AS k FROM o WHERE label = 0)
SELECT {0}, label FROM o WHERE label = 1 UNION ALL SELECT {0}, label FROM z, n WHERE p = 0 OR n <= 10 * p OR k < 5 * p"""


@query("WITH o AS (SELECT o_orderkey, (o_totalprice > 480000)::BIGINT AS label, md5(o_orderkey::VARCHAR) AS d FROM orders)" + _BALANCED.format("o_orderkey"))
def prj_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ15"""
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") > 480_000).cast("int").alias("label"))
    return r4(FE.rebalance(o, "label", "o_orderkey"))


@query("WITH o AS (SELECT event_id, (value > (SELECT max(value) FROM events) * 0.995)::BIGINT AS label, md5(event_id::VARCHAR) AS d FROM events)" + _BALANCED.format("event_id"))
def prj_rebalance_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ15: a class of which there are a few rows in many thousands"""
    e = table(spark, sf_dir, "events")
    most = e.agg((F.max("value") * 0.995).alias("most"))
    return r4(FE.rebalance(e.join(F.broadcast(most)).select("event_id", (F.col("value") > F.col("most")).cast("int").alias("label")), "label", "event_id"))


@query("SELECT l_orderkey, l_partkey, coalesce(nullif(l_returnflag, 'N'), 'CNA') AS flag, coalesce(CASE WHEN l_tax > 0.02 THEN round(l_tax, 4) END, 0) AS tax FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND nullif(l_discount, 0) IS NOT NULL")
def prj_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ05-PRJ08"""
    x = table(spark, sf_dir, "lineitem").where(F.col("l_quantity").between(10, 20))
    x = x.withColumns({"l_discount": F.nullif("l_discount", F.lit(0.0)), "flag": F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("CNA")), "tax": F.when(F.col("l_tax") > 0.02, F.round("l_tax", 4))})
    return x.na.drop(subset=["l_discount"]).fillna(0.0, ["tax"]).select("l_orderkey", "l_partkey", "flag", "tax")


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem WHERE l_discount > 0.05 UNION SELECT DISTINCT s_suppkey, 'none' FROM supplier")
def se_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE01, SE02, PRJ09"""
    a = table(spark, sf_dir, "lineitem").where("l_discount > 0.05").select("l_suppkey", "l_returnflag")
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.lit("none").alias("l_returnflag"))
    return FE.union_all([a, b]).distinct()


_PLAIN = "strip_accents(lower({}))"
for _letter, _spelled in X.SPELLED.items():
    _PLAIN = f"replace({_PLAIN}, '{_letter}', '{_spelled}')"


@query(f"SELECT conv_id, turn, {_PLAIN.format('role')} AS role, coalesce({_PLAIN.format('text')}, '') AS plain, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS ascii FROM conversations")
def udf_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF01, UDF02: as SQL functions"""
    X.register_sql_functions(spark)
    return table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "strip_accents(role) as role", "strip_accents(text) as plain", "ascii_only(text) as ascii")


_RATINGS = "WITH r AS (SELECT o_custkey AS u, l_partkey AS i, (1 + l_quantity::BIGINT % 5)::DOUBLE AS rating, o_orderdate AS ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey) "


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(u, i, rating, ts): who bought what."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    r = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return r.select(F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"), (1 + F.col("l_quantity").cast("long") % 5).cast("double").alias("rating"), F.col("o_orderdate").alias("ts"))


@query(_RATINGS + "SELECT u, i, rating FROM r WHERE u IN (SELECT u FROM r GROUP BY u HAVING count(*) >= 40) AND i IN (SELECT i FROM r GROUP BY i HAVING count(*) >= 30)")
def jn_frequent_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN02, AG06"""
    return FE.frequent_only(ratings(spark, sf_dir), "u", "i", 40, 30).select("u", "i", "rating")


@query(_RATINGS + "SELECT u, i, round(rating * exp(-date_diff('day', ts, TIMESTAMP '2002-01-01') / 365.0), 5) AS decayed_rating FROM r")
def fe_decayed_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE04"""
    return FE.decayed_rating(ratings(spark, sf_dir), "rating", "ts", "2002-01-01").select("u", "i", F.round("decayed_rating", 5).alias("decayed_rating"))


@query(_RATINGS + """, m AS (SELECT u, p_type AS t, avg(rating) AS m FROM r JOIN part ON p_partkey = i GROUP BY ALL HAVING count(*) >= 2)
SELECT u, round(coalesce(max(m) FILTER (t = 'ECONOMY'), 0), 4) AS ECONOMY, round(coalesce(max(m) FILTER (t = 'SMALL'), 0), 4) AS SMALL, round(coalesce(max(m) FILTER (t = 'LARGE'), 0), 4) AS LARGE FROM m GROUP BY u""")
def fe_user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE05, AG05"""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("i"), F.col("p_type").alias("t"))
    return r4(FE.user_profiles(ratings(spark, sf_dir).join(parts, "i"), "u", "t", "rating", ["ECONOMY", "SMALL", "LARGE"]))


@query(_RATINGS + "SELECT u, count(*) AS n_ratings, round(avg(rating), 4) AS avg_rating, round(stddev(rating), 4) AS std_rating, min(rating) AS min_rating, max(rating) AS max_rating FROM r GROUP BY u")
def fe_user_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE05, AG01"""
    return r4(FE.user_statistics(ratings(spark, sf_dir), "u", "rating"))


@query(_RATINGS + "SELECT p_partkey AS i, p_brand AS brand, round(coalesce(avg(rating), 0), 4) AS avg_rating, round(coalesce(stddev(rating), 0), 4) AS std_rating, count(rating) AS popularity, count(DISTINCT u) AS unique_users FROM part LEFT JOIN r ON i = p_partkey GROUP BY ALL")
def fe_item_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE06, AG03, JN01, PRJ07"""
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("i"), F.col("p_brand").alias("brand"))
    return r4(FE.item_profiles(items, ratings(spark, sf_dir), "i", "u", "rating"))


@query("SELECT c_custkey AS k, o_orderkey AS account FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, o_orderkey FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1997-07-01') ON c_custkey = o_custkey")
def jn_attach_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN04"""
    cohort = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    src = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("account"), "o_orderdate")
    return FE.attach_accounts(cohort, src, "k", "account", "o_orderdate", "1997-01-01", "1997-07-01")


def _cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.explode(F.array(*(F.lit(d).cast("date") for d in ("1998-06-30", "1999-06-30")))).alias("vintage"))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("snapshot"), F.col("o_totalprice").alias("x"))


_COHORT = """WITH c AS (SELECT c_custkey AS k, unnest([DATE '1998-06-30', DATE '1999-06-30']) AS vintage FROM customer),
j AS (SELECT c.k, vintage, o_totalprice AS x, (date_diff('month', date_trunc('month', o_orderdate), date_trunc('month', vintage)))::BIGINT AS months_back FROM c JOIN orders ON o_custkey = c.k
  WHERE date_diff('month', date_trunc('month', o_orderdate), date_trunc('month', vintage)) BETWEEN 1 AND 12) """


@query(_COHORT + "SELECT k, vintage::VARCHAR AS vintage, months_back, round(x, 2) AS x FROM j")
def jn_cohort_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN08"""
    out = FE.cohort_history(_cohort(spark, sf_dir), _history(spark, sf_dir), "k", "vintage", "snapshot", 12, lag=1)
    return out.select("k", F.col("vintage").cast("string").alias("vintage"), F.col("months_back").cast("long").alias("months_back"), F.round("x", 2).alias("x"))


@query(_COHORT + """SELECT k, vintage::VARCHAR AS vintage, round(avg(x) FILTER (months_back BETWEEN 1 AND 3), 3) AS mean_x_3m, round(sum(x) FILTER (months_back BETWEEN 1 AND 3), 2) AS sum_x_3m, round(avg(x) FILTER (months_back BETWEEN 1 AND 12), 3) AS mean_x_12m, round(sum(x) FILTER (months_back BETWEEN 1 AND 12), 2) AS sum_x_12m,
  round((avg(x) FILTER (months_back BETWEEN 1 AND 3)) / nullif(avg(x) FILTER (months_back BETWEEN 1 AND 12), 0), 4) AS ratio_x_3m_12m FROM j GROUP BY k, vintage""")
def fe_window_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE07, FE08"""
    rows = FE.cohort_history(_cohort(spark, sf_dir), _history(spark, sf_dir), "k", "vintage", "snapshot", 12, lag=1)
    out = FE.window_ratios(FE.window_aggregates(rows, ["k", "vintage"], ["x"], [3, 12], ("mean", "sum")), ["x"], [3, 12])
    digits = {"mean_x_3m": 3, "mean_x_12m": 3, "sum_x_3m": 2, "sum_x_12m": 2, "ratio_x_3m_12m": 4}
    return out.select("k", F.col("vintage").cast("string").alias("vintage"), *(F.round(c, d).alias(c) for c, d in digits.items()))


def exact_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).withColumn("x", F.col("x").cast("decimal(12, 2)"))


_EXACT = _COHORT.replace("o_totalprice AS x", "o_totalprice::DECIMAL(12, 2) AS x")
_SUMMED = ", ".join(f"(sum(x) FILTER (months_back <= {w}))::DOUBLE AS sum_x_{w}m, (sum(x) FILTER (months_back <= {w}))::DOUBLE / count(x) FILTER (months_back <= {w}) AS mean_x_{w}m" for w in (1, 3, 6, 12))


@query(_EXACT + f", w AS (SELECT k, vintage::VARCHAR AS vintage, {_SUMMED} FROM j GROUP BY k, vintage) SELECT *, mean_x_1m / mean_x_12m AS ratio_x_1m_12m, mean_x_3m / mean_x_12m AS ratio_x_3m_12m FROM w")
def fe_window_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE07, FE08: from running sums of months, exact to the last digit"""
    out = cohort_windows(_cohort(spark, sf_dir), exact_history(spark, sf_dir), "k", "vintage", "snapshot", ["x"], [1, 3, 6, 12], ("sum", "mean"))
    out = FE.window_ratios(out, ["x"], [1, 3, 6, 12])
    return out.select("k", F.col("vintage").cast("string").alias("vintage"), *(F.col(f"{f}_x_{w}m").cast("double").alias(f"{f}_x_{w}m") for w in (1, 3, 6, 12) for f in ("sum", "mean")), "ratio_x_1m_12m", "ratio_x_3m_12m")


_WINDOWED = [1, 2, 3, 6, 9, 12]


@query(_COHORT + "SELECT k, vintage::VARCHAR AS vintage, " + ", ".join(f"round(min(x) FILTER (months_back <= {w}), 2) AS min_x_{w}m, round(max(x) FILTER (months_back <= {w}), 2) AS max_x_{w}m, round(stddev(x) FILTER (months_back <= {w}), 2) AS std_x_{w}m, count(x) FILTER (months_back <= {w}) AS count_x_{w}m" for w in _WINDOWED) + " FROM j GROUP BY k, vintage")
def fe_many_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE07: six windows of four functions, from one index of months"""
    out = cohort_windows(_cohort(spark, sf_dir), _history(spark, sf_dir), "k", "vintage", "snapshot", ["x"], _WINDOWED, ("min", "max", "std", "count"))
    return out.select("k", F.col("vintage").cast("string").alias("vintage"), *(F.col(f"count_x_{w}m") if f == "count" else (F.round(f"{f}_x_{w}m", 2) + F.lit(0.0)).alias(f"{f}_x_{w}m") for w in _WINDOWED for f in ("min", "max", "std", "count")))


@query(_COHORT + "SELECT k, vintage::VARCHAR AS vintage, round(max(x) FILTER (months_back = 1), 2) AS x_1, round(max(x) FILTER (months_back = 2), 2) AS x_2, count(x) AS n FROM j GROUP BY k, vintage")
def ag_pivot_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG12, AG13"""
    rows = FE.cohort_history(_cohort(spark, sf_dir), _history(spark, sf_dir), "k", "vintage", "snapshot", 12, lag=1)
    n = FE.group_by_config(rows, ["k", "vintage"], [("x", "count", "n")])
    return FE.pivot_by_month(rows, ["k", "vintage"], ["x"], 3).join(n, ["k", "vintage"]).select("k", F.col("vintage").cast("string").alias("vintage"), F.round("x_1", 2).alias("x_1"), F.round("x_2", 2).alias("x_2"), "n")


@query("""WITH x AS (SELECT o_orderkey, o_orderpriority AS g, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS v FROM orders), g AS (SELECT g, avg(v) AS m FROM x GROUP BY g)
SELECT o_orderkey, round(coalesce(v, m), 2) AS v FROM x JOIN g USING (g)""")
def fe_fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE09"""
    x = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("g"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("v"))
    return FE.fill_missing(x, {"v": ("mean", 0.0)}, ["g"]).select("o_orderkey", F.round("v", 2).alias("v"))


@query("""WITH f AS (SELECT o_custkey AS k, min(o_orderdate) AS first, sum(o_totalprice) AS s FROM orders GROUP BY 1)
SELECT k, date_diff('month', date_trunc('month', first), DATE '1996-01-01') AS mob, CASE WHEN date_diff('month', date_trunc('month', first), DATE '1996-01-01') >= 6 THEN round(s, 2) END AS s FROM f""")
def fe_months_on_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE10"""
    f = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderdate").alias("first"), F.round(F.sum("o_totalprice"), 2).alias("s")).withColumn("vintage", F.lit("1996-01-31").cast("date"))
    return r4(FE.months_on_book(f, "first", "vintage", {"s": 6}).select("k", "mob", "s"))


@query("""WITH n AS (SELECT p_type AS v, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS k FROM part GROUP BY p_type) SELECT p_partkey, k::DOUBLE AS p_type_index FROM part JOIN n ON p_type = v""")
def fe_string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE02"""
    return ML.encode(table(spark, sf_dir, "part").select("p_partkey", "p_type"), ["p_type"])[0].select("p_partkey", "p_type_index")


@query("SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev(p_size) FROM part), 4) AS p_size_scaled FROM part")
def fe_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE03"""
    return r4(ML.standardise(table(spark, sf_dir, "part"), ["p_size"]).select("p_partkey", "p_size_scaled"))


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders")
def wn_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN06"""
    return r4(FE.rank_in_group(table(spark, sf_dir, "orders"), "o_custkey", [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "rank"))
