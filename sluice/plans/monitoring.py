"""Queries of data quality, drift and arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import arrival as AR
from sluice.operators import drift as DR
from sluice.operators import models as ML
from sluice.operators import quality as DQ
from sluice.plans.base import query, r4, table

RULES = [
    DQ.Rule("key_there", "completeness", ("o_orderkey",)),
    DQ.Rule("key_unique", "uniqueness", ("o_orderkey",)),
    DQ.rule_from_config({"name": "pair_unique", "type": "uniqueness", "columns": ["o_custkey", "o_orderstatus"], "threshold": 0.5}),
    DQ.rule_from_config({"name": "price_range", "type": "range", "column": "o_totalprice", "min": 1000, "max_value": 400000, "threshold": 0.7}),
    DQ.rule_from_config({"name": "priority_form", "type": "regex", "column": "o_orderpriority", "pattern": "^[1-3]-", "threshold": 0.9}),
    DQ.Rule("fresh", "freshness", ("o_orderdate",), as_of="2001-08-03 00:00:00", max_hours=72.0),
    DQ.Rule("price_outliers", "outlier", ("o_totalprice",), threshold=0.99, max_z=1.5),
    DQ.Rule("off", "range", ("o_totalprice",), low=1e9, enabled=False),
]

_RULES_SQL = """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev(o_totalprice) AS d FROM orders),
a AS (SELECT count(*) AS total, count(o_orderkey) AS key_there, count(DISTINCT o_orderkey) AS key_unique, count(DISTINCT (o_custkey, o_orderstatus)) AS pair_unique,
  count(*) FILTER (o_totalprice BETWEEN 1000 AND 400000) AS price_range, count(*) FILTER (regexp_matches(o_orderpriority, '^[1-3]-')) AS priority_form,
  CASE WHEN (epoch(TIMESTAMP '2001-08-03') - epoch(max(o_orderdate))) / 3600 <= 72 THEN count(*) ELSE 0 END AS fresh,
  count(*) FILTER (abs((o_totalprice - m) / d) <= 1.5) AS price_outliers FROM orders, s),
r AS (UNPIVOT a ON key_there, key_unique, pair_unique, price_range, priority_form, fresh, price_outliers INTO NAME rule VALUE passed_records),
t AS (SELECT * FROM (VALUES ('key_there', 'completeness', 1.0), ('key_unique', 'uniqueness', 1.0), ('pair_unique', 'uniqueness', 0.5), ('price_range', 'range', 0.7), ('priority_form', 'pattern', 0.9), ('fresh', 'freshness', 1.0), ('price_outliers', 'outlier', 0.99)) AS x(rule, kind, threshold)),
res AS (SELECT rule, kind, 'error' AS severity, passed_records::BIGINT AS passed_records, (total - passed_records)::BIGINT AS failed_records, total, round(passed_records / total, 4) AS score, threshold::DOUBLE AS threshold, passed_records / total >= threshold AS passed, '' AS details FROM r JOIN t USING (rule))
"""


@query(_RULES_SQL + "SELECT * FROM res")
def dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ01-DQ05, DQ07, DQ08, DQ11"""
    return r4(DQ.validate(table(spark, sf_dir, "orders"), RULES))


@query(_RULES_SQL + "SELECT round(avg(score), 4) AS overall_score, count(*) AS total_rules, count(*) FILTER (passed) AS passed_rules, count(*) FILTER (NOT passed) AS failed_rules FROM res")
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ09"""
    return r4(DQ.summary(r4(DQ.validate(table(spark, sf_dir, "orders"), RULES))))


@query(_RULES_SQL + "SELECT 'orders' AS dataset, rule, score, passed, '2002-01-01' AS recorded_at FROM res")
def dq_score_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ12"""
    return r4(DQ.score_history(DQ.validate(table(spark, sf_dir, "orders"), RULES), "orders", "2002-01-01").withColumn("recorded_at", F.date_format("recorded_at", "yyyy-MM-dd")))


_PROFILED = (("p_partkey", "bigint", 1), ("p_name", "string", 0), ("p_size", "int", 1), ("p_retailprice", "double", 1))


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS type, count(*) AS total, count(*) - count({c}) AS nulls, round(count({c}) / count(*), 4) AS completeness, {f'round(avg({c}), 4)' if n else 'NULL::DOUBLE'} AS mean, {f'round(stddev({c}), 4)' if n else 'NULL::DOUBLE'} AS stddev, min({c})::VARCHAR AS min, max({c})::VARCHAR AS max, count(DISTINCT {c}) AS distinct, round(count(DISTINCT {c}) / count(*), 4) AS cardinality FROM part"
    for c, t, n in _PROFILED
).replace("AS column", 'AS "column"').replace("AS distinct", 'AS "distinct"'))
def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ10"""
    return r4(DQ.profile(table(spark, sf_dir, "part").select(*(c for c, _, _ in _PROFILED)), exact_distinct=True))


@query("""SELECT o_orderkey, array_to_string(list_filter([CASE WHEN NOT (o_totalprice BETWEEN 1000 AND 400000) THEN 'price_range' END, CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-3]-') THEN 'priority_form' END], lambda x: x IS NOT NULL), ',') AS violations FROM orders""")
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ13"""
    return DQ.quarantine(table(spark, sf_dir, "orders"), RULES).select("o_orderkey", F.array_join("violations", ",").alias("violations"))


BINS: DR.Bins = {"o_totalprice": [(100_000.0, 1000), (200_000.0, 1100), (300_000.0, 900), (0.0, 2000)], "o_shippriority": [(0.0, 10)]}


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("vintage"), F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")).alias("o_totalprice"), F.lit(1.0).alias("o_shippriority"))


_STABLE = """
WITH x AS (SELECT strftime(o_orderdate, '%Y-%m') AS vintage, CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS p FROM orders),
b AS (SELECT vintage, 'o_totalprice' AS variable, CASE WHEN p <= 100000 THEN 1 WHEN p <= 200000 THEN 2 WHEN p <= 300000 THEN 3 ELSE 4 END AS bin FROM x UNION ALL SELECT vintage, 'o_shippriority', 1 FROM x),
c AS (SELECT vintage, variable, bin, count(*) AS n FROM b GROUP BY ALL),
d AS (SELECT * FROM (VALUES ('o_totalprice', 1, 1000, 0.2), ('o_totalprice', 2, 1100, 0.22), ('o_totalprice', 3, 900, 0.18), ('o_totalprice', 4, 2000, 0.4), ('o_shippriority', 1, 10, 1.0)) AS t(variable, bin, count_dev, dist_dev)),
f AS (SELECT v.vintage, d.variable, d.bin, d.count_dev, d.dist_dev::DOUBLE AS dist_dev, coalesce(n, 0) AS count_current FROM (SELECT DISTINCT vintage FROM x) v CROSS JOIN d LEFT JOIN c ON c.vintage = v.vintage AND c.variable = d.variable AND c.bin = d.bin),
g AS (SELECT *, count_current / sum(count_current) OVER (PARTITION BY vintage, variable) AS dist_current FROM f),
h AS (SELECT *, CASE WHEN dist_current > 0 AND dist_dev > 0 THEN (dist_current - dist_dev) * ln(dist_current / dist_dev) ELSE 0 END AS psi FROM g),
tot AS (SELECT vintage, variable, sum(psi) AS total_psi FROM h GROUP BY ALL)
"""


@query(_STABLE + "SELECT vintage, variable, bin::BIGINT AS bin, n AS count FROM c")
def dr_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR01"""
    return r4(DR.bin_counts(_monthly(spark, sf_dir), BINS, ["vintage"]))


@query(_STABLE + "SELECT vintage, variable, bin::BIGINT AS bin, count_dev::BIGINT AS count_dev, dist_dev, count_current, round(dist_current, 4) AS dist_current, round(psi, 4) AS psi FROM h")
def dr_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR02, JN03, JN07"""
    return r4(DR.stability(_monthly(spark, sf_dir), BINS, ["vintage"]))


@query(_STABLE + "SELECT vintage, variable, round(total_psi, 4) AS total_psi, total_psi > 0.02 AS over, total_psi > 0.05 AS over_hard FROM tot")
def dr_totals_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR03, DR05, AG04"""
    return r4(DR.gate(DR.stability_totals(DR.stability(_monthly(spark, sf_dir), BINS, ["vintage"]), ["vintage"]), 0.02, 0.05))


@query(_STABLE + """, w AS (SELECT *, lag(total_psi) OVER (PARTITION BY variable ORDER BY vintage) AS p FROM tot)
SELECT vintage, variable, round(total_psi, 4) AS total_psi, round(p, 4) AS previous_psi, round((total_psi - p) / nullif(p, 0), 2) AS change, coalesce(abs((total_psi - p) / nullif(p, 0)) >= 0.1, false) AS changed FROM w""")
def dr_period_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR06, JN05"""
    out = DR.period_change(DR.stability_totals(DR.stability(_monthly(spark, sf_dir), BINS, ["vintage"]), ["vintage"]), "vintage")
    return r4(out.withColumn("change", F.round("change", 2)))


_PCT = ", ".join(f"round(quantile_cont(x, {p / 100}), 4) AS p{p}" for p in DR.PERCENTS)


@query(f"""WITH v AS (SELECT l_returnflag, unnest(['l_quantity', 'l_tax']) AS variable, unnest([l_quantity, CASE WHEN l_linenumber <> 3 THEN l_tax END]) AS x FROM lineitem)
SELECT l_returnflag, variable, count(*) AS count, count(*) - count(x) AS n_miss, round(stddev(x), 4) AS std, round(avg(x), 4) AS mean, min(x) AS min, {_PCT}, max(x) AS max FROM v GROUP BY ALL""")
def dr_quality_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR04, AG09"""
    x = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("l_tax"))
    return r4(DR.quality_table(x, ["l_quantity", "l_tax"], ["l_returnflag"], accuracy=None))


_DRIFT = """WITH r AS (SELECT o_totalprice AS x FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'), c AS (SELECT o_totalprice AS x FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM r),
k AS (SELECT 'r' AS side, least(greatest(floor((x - lo) / (hi - lo) * 10) + 1, 1), 10) AS bin FROM r, b UNION ALL SELECT 'c', least(greatest(floor((x - lo) / (hi - lo) * 10) + 1, 1), 10) FROM c, b),
n AS (SELECT bin, count(*) FILTER (side = 'r') AS r, count(*) FILTER (side = 'c') AS c FROM k GROUP BY bin),
s AS (SELECT bin, r / sum(r) OVER () AS r, c / sum(c) OVER () AS c FROM n),
p AS (SELECT sum(CASE WHEN r > 0 AND c > 0 THEN (c - r) * ln(c / r) ELSE 0 END) AS psi FROM s) """


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return o.where(old), o.where(~old)


@query(_DRIFT + "SELECT 'o_totalprice' AS variable, round(psi, 5) AS psi, round(psi, 5) AS overall_psi, psi > 0.1 AS drifted, psi > 0.1 AS drift_detected FROM p")
def dr_column_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR07, AG10"""
    return r4(DR.column_drift(*_sides(spark, sf_dir), ["o_totalprice"]), 5)


@query(_DRIFT + "SELECT bin::BIGINT AS bin, count(*) AS count, 'o_totalprice' AS variable FROM k WHERE side = 'c' GROUP BY bin")
def dr_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG10"""
    ref, cur = _sides(spark, sf_dir)
    return r4(DR.histogram(cur, ["o_totalprice"], 10, like=ref))


_PRED = "WITH p AS (SELECT o_orderkey, (o_totalprice > 250000)::INT AS prediction, (o_orderstatus = 'F')::INT AS label FROM orders), c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM p) "
_CONF = "SELECT tp, fp, tn, fn, round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall, round((tp + tn) / (tp + fp + tn + fn), 4) AS accuracy, round(tn / (tn + fp), 4) AS specificity, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))), 4) AS f1"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") > 250_000).cast("int").alias("prediction"), F.col("o_totalprice").alias("value"))


def actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))


@query(_PRED + _CONF + ", (tp + tn) / (tp + fp + tn + fn) < 0.7 AS degraded FROM c")
def dr_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR09, ML06, AG11"""
    return r4(ML.performance(predictions(spark, sf_dir), actuals(spark, sf_dir), "o_orderkey", "label", "prediction", 0.7))


@query(_DRIFT.replace("p AS (SELECT sum", "pd AS (SELECT sum") + ", " + _PRED[5:].replace(", c AS (", ", c2 AS (") + "SELECT psi > 0.1 AS drift_detected, (tp + tn) / (tp + fp + tn + fn) < 0.7 AS degraded, psi > 0.1 OR (tp + tn) / (tp + fp + tn + fn) < 0.7 AS retrain FROM pd, c2")
def dr_retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR08"""
    perf = ML.performance(predictions(spark, sf_dir), actuals(spark, sf_dir), "o_orderkey", "label", "prediction", 0.7)
    return DR.retrain_flag(DR.column_drift(*_sides(spark, sf_dir), ["o_totalprice"]), perf)


_COUNTS = """WITH m AS (SELECT 'orders' AS table_name, last_day(o_orderdate) AS partition, count(*) AS count FROM orders GROUP BY ALL UNION ALL SELECT 'lines', last_day(l_shipdate), count(*) FROM lineitem GROUP BY ALL) """


def _counts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    o, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return [AR.partition_counts(o, "orders", F.col("o_orderdate"), daily_to_month=True), AR.partition_counts(line, "lines", F.col("l_shipdate"), daily_to_month=True)]


@query(_COUNTS + """, r AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY partition DESC) AS k FROM m)
SELECT table_name, partition::VARCHAR AS partition, count, '2001-06-30' AS cohort_date, '2001-06-30' AS window_start, '2001-02-28' AS window_end FROM r WHERE k > 1 AND k <= 6""")
def ar_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR10, AG07, WN09, SE03"""
    return r4(AR.history(_counts(spark, sf_dir), "2001-08-15", lag=1, periods=5))


@query("""WITH c AS (SELECT last_day(o_orderdate) AS p, count(*) AS n FROM orders GROUP BY ALL), s AS (SELECT last_day(DATE '2001-12-01' - to_months(i::INT)) AS p FROM range(0, 12) t(i))
SELECT 'orders' AS table_name, s.p::VARCHAR AS partition, coalesce(n, 0) AS count, coalesce(n, 0) > 0 AS arrived FROM s LEFT JOIN c ON c.p = s.p""")
def ar_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR11, JN03"""
    return r4(AR.expected_partitions(_counts(spark, sf_dir)[0], "orders", "2002-01-15", 12, lag=1))


@query(_COUNTS + """, w AS (SELECT *, count / lag(count) OVER (PARTITION BY table_name ORDER BY partition) AS r, lead(partition) OVER (PARTITION BY table_name ORDER BY partition) IS NULL AS newest FROM m)
SELECT table_name, partition::VARCHAR AS partition, count, round(r, 4) AS ratio, CASE WHEN r IS NULL THEN 'grey' WHEN r BETWEEN 0.75 AND 1.25 THEN 'green' WHEN r BETWEEN 0.5 AND 1.75 THEN 'yellow' ELSE 'red' END AS band FROM w WHERE newest""")
def ar_growth_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR12, WN08, WN10"""
    a, b = _counts(spark, sf_dir)
    return r4(AR.growth_bands(a.unionByName(b)))


@query(_COUNTS + "SELECT table_name, round(regr_slope(count, date_diff('day', DATE '1970-01-01', partition)), 4) AS slope, round(regr_intercept(count, date_diff('day', DATE '1970-01-01', partition)), 2) AS intercept FROM m GROUP BY table_name")
def ar_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR13"""
    a, b = _counts(spark, sf_dir)
    return r4(AR.trend(a.unionByName(b)).withColumn("intercept", F.round("intercept", 2)))


@query("SELECT 'orders' AS table_name, last_day(o_orderdate)::VARCHAR AS partition, count(*) AS count FROM orders GROUP BY ALL ORDER BY partition DESC LIMIT 4")
def ar_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST01"""
    return r4(AR.newest(_counts(spark, sf_dir)[0], 4))


@query("SELECT 'lines' AS table_name, coalesce(nullif(l_returnflag, 'N'), 'CNA') AS campaign, count(*) AS count FROM lineitem GROUP BY ALL")
def ar_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DR10, PRJ08"""
    return AR.campaign_counts(table(spark, sf_dir, "lineitem").withColumn("c", F.nullif("l_returnflag", F.lit("N"))), "lines", "c")


@query("""WITH c AS (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders WHERE o_orderkey % 5 = 0 GROUP BY ALL), s AS (SELECT unnest(range((SELECT min(d) FROM c)::TIMESTAMP, (SELECT max(d) FROM c)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d)
SELECT 'orders' AS table_name, s.d::VARCHAR AS partition, coalesce(n, 0) AS count FROM s LEFT JOIN c ON c.d = s.d""")
def ar_every_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar, JN03: counts of every day, zeros included"""
    o = table(spark, sf_dir, "orders")
    fifth = AR.partition_counts(o.withColumn("day", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderdate"))), "orders", F.col("day")).where("partition is not null")
    return r4(AR.with_every_day(fifth))
