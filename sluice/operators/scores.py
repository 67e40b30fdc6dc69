"""Score publishing, experiments and metric tables (SP, AB, MT operators)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.expressions import hash_share, iso_utc
from sluice.operators.ranks import global_ntile  # noqa: F401  a part of score publishing


def assign_decile(df: DataFrame, score: str, mins: list[float], maxs: list[float]) -> DataFrame:
    """SP02: decile by closed ranges, the first that matches; quartile groups of deciles 1-2, 3-5, 6-8, 9-10; 0 without a match."""
    d = F
    for k, (lo, hi) in enumerate(zip(mins, maxs, strict=True), 1):
        d = d.when(F.col(score).between(lo, hi), k)
    out = df.withColumn("decile", d.otherwise(0))
    q = F.when(F.col("decile").between(1, 2), 1).when(F.col("decile").between(3, 5), 2).when(F.col("decile").between(6, 8), 3).when(F.col("decile").between(9, 10), 4).otherwise(0)
    return out.withColumn("quartile", q)


def normalise_scores(df: DataFrame, customer: str, score: str, score_date: str, process_date: str, name: str) -> DataFrame:
    """SP01: (customer_id, score, score_info_dt, score_process_dt, score_name), dates as ISO-8601 in UTC."""
    return df.select(F.col(customer).alias("customer_id"), F.col(score).alias("score"), iso_utc(F.col(score_date)).alias("score_info_dt"), iso_utc(F.lit(process_date).cast("timestamp")).alias("score_process_dt"), F.lit(name).alias("score_name"))


def decimal_text(c: Column, digits: int = 4) -> Column:
    """A double rounded to `digits`, as plain digits with one or more after the point; what rounds to zero keeps its sign."""
    r = F.round(c, digits)
    zero = F.when(c.cast("string").startswith("-"), "-0.0").otherwise("0.0")
    plain = F.regexp_replace(r.cast(f"decimal(38, {digits})").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(r == 0, zero).when(F.abs(r) < 1e15, plain).otherwise(r.cast("string"))


def score_documents(df: DataFrame) -> DataFrame:
    """SP04: (customer_id, risk_score): one JSON document per row, from a nested struct in the contract's order of keys."""
    date = lambda c: F.struct(F.col(c).alias("$date"))
    doc = F.struct(
        date("score_process_dt").alias("credit_approved_dt"),
        F.lit(True).alias("credit_approved_flag"),
        F.col("decile").alias("credit_score_decile_val"),
        F.col("quartile").alias("credit_score_quartile_val"),
        F.struct(decimal_text(F.col("score")).alias("$numberDecimal")).alias("score"),
        date("score_info_dt").alias("score_info_dt"),
        F.col("score_name").alias("score_name"),
        date("score_process_dt").alias("score_process_dt"),
    )
    return df.select("customer_id", F.to_json(doc).alias("risk_score"))


def segment_documents(df: DataFrame, process_date: str, segment: str | None = None) -> DataFrame:
    """SP05: (customer_id, customer_segments): an array of one JSON document; "none" where there is no segment."""
    seg = F.coalesce(F.col(segment), F.lit("none")) if segment else F.lit("none")
    doc = F.struct(seg.alias("segment_name"), F.struct(iso_utc(F.lit(process_date).cast("timestamp")).alias("$date")).alias("segment_dt"))
    return df.select("customer_id", F.array(F.to_json(doc)).alias("customer_segments"))


def publish(scores: list[DataFrame], segments: DataFrame, model_type: int) -> DataFrame:
    """SP04, SP06: (model_type_execution, customer_id, risk_scores, customer_segments): the customers that all scores have. Write it
    with tables.overwrite_partitions()."""
    every = scores[0].withColumnRenamed("risk_score", "_s0")
    for k, s in enumerate(scores[1:], 1):
        every = every.join(s.withColumnRenamed("risk_score", f"_s{k}"), "customer_id")
    return every.join(segments, "customer_id").select(F.lit(model_type).alias("model_type_execution"), "customer_id", F.array(*(f"_s{k}" for k in range(len(scores)))).alias("risk_scores"), "customer_segments")


def assign_arms(users: DataFrame, user: str, split: float) -> DataFrame:
    """AB01: treatment where the hash share of the user's id is below split, else control."""
    return users.withColumn("arm", F.when(hash_share(F.col(user)) / 1000 < split, "treatment").otherwise("control"))


def compare_arms(df: DataFrame, value: str, arm: str = "arm", kind: str = "mean", min_sample: int = 1000, critical: float = 1.959963984540054) -> DataFrame:
    """AB02: one row: sizes, means, difference, relative lift, z, confidence bounds, whether |z| > critical, and what to do.

    kind "rate": pooled two-proportion z; "mean": Welch's statistic with the normal critical value."""
    g = df.groupBy(arm).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
    side = lambda a: [F.max(F.when(F.col(arm) == a, F.col(c))).alias(f"{c}_{a}") for c in "nmv"]
    one = g.agg(*side("treatment"), *side("control")).fillna(0, ["n_treatment", "n_control"])
    nt, nc, mt, mc = (F.col(x) for x in ("n_treatment", "n_control", "m_treatment", "m_control"))
    pooled = (mt * nt + mc * nc) / (nt + nc)
    own = F.sqrt(F.try_divide(F.col("v_treatment"), nt) + F.try_divide(F.col("v_control"), nc))
    se = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), nt) + F.try_divide(F.lit(1.0), nc))) if kind == "rate" else own
    z = F.try_divide(mt - mc, se)
    enough = (nt >= min_sample) & (nc >= min_sample)
    sig = F.coalesce(F.abs(z) > critical, F.lit(False))
    return one.select(
        "n_treatment", "n_control", mt.alias("mean_treatment"), mc.alias("mean_control"), (mt - mc).alias("difference"), F.try_divide(mt - mc, mc).alias("lift"), z.alias("z"),
        (mt - mc - critical * own).alias("ci_low"), (mt - mc + critical * own).alias("ci_high"), sig.alias("significant"),
        F.when(~enough, "insufficient_data").when(~sig, "no_difference").when(mt > mc, "adopt_treatment").otherwise("keep_control").alias("recommendation"),
    )


def p_value(z: float) -> float:
    """AB02: two-sided, of the one row's statistic."""
    return math.erfc(abs(z) / math.sqrt(2))


#: MT03. Bounds of job durations in seconds.
DURATION_BOUNDS = (0.1, 0.5, 1.0, 5.0, 10.0, 30.0, 60.0, 300.0, 600.0, 1800.0, 3600.0)


def counter_totals(events: DataFrame, name: str, labels: list[str], value: str) -> DataFrame:
    """MT01"""
    return events.groupBy(name, *labels).agg(F.sum(value).alias("total"))


def gauge_latest(events: DataFrame, name: str, labels: list[str], value: str, ts: str, tie: str) -> DataFrame:
    """MT02: the newest value; of the same time, the one with the largest tie."""
    return events.groupBy(name, *labels).agg(F.max_by(value, F.struct(ts, tie)).alias("value"), F.max(ts).alias("ts"))


def histogram_buckets(events: DataFrame, name: str, value: str, bounds: tuple[float, ...] = DURATION_BOUNDS) -> DataFrame:
    """MT03: (name, upper_bound, cumulative count, total_count, total_sum), +Infinity last; one aggregate, then unpivoted."""
    every = (*bounds, float("inf"))
    one = events.groupBy(name).agg(F.count(value).alias("total_count"), F.sum(value).alias("total_sum"), *(F.count_if(F.col(value) <= b).alias(f"b{k}") for k, b in enumerate(every)))
    return one.select(name, "total_count", "total_sum", F.inline(F.array(*(F.struct(F.lit(b).alias("upper_bound"), F.col(f"b{k}").alias("cumulative")) for k, b in enumerate(every)))))


def alerts(events: DataFrame, ts: str, bad: Column, width: str = "5 minutes", most: float = 0.1) -> DataFrame:
    """MT04: (window_start, n, failures, rate): windows whose share of bad events is over `most`."""
    g = events.groupBy(F.window(F.col(ts).cast("timestamp"), width).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("failures"))
    return g.select(F.col("w.start").alias("window_start"), "n", "failures", (F.col("failures") / F.col("n")).alias("rate")).where(F.col("rate") > most)
