"""Stability and drift: binned shares against a development sample, drift of columns, gates (DR01-DR09, AG09, AG10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.functions.expressions import first_bin

#: variable -> [(upper bound, development count)], in order; the last bound is not read.
Bins = dict[str, list[tuple[float, int]]]
#: The percentiles of the quality table.
PERCENTS = (1, 5, 10, 20, 25, 30, 40, 50, 60, 70, 75, 80, 90, 95, 99)


class DriftError(ValueError):
    """Too many variables over the threshold."""


def stability_term(cur: Column, dev: Column, formula: str = "ln") -> Column:
    """(cur - dev) * ln(cur / dev), 0 where either share is 0; formula "sqrt" takes a root in place of the logarithm."""
    ratio = F.try_divide(cur, dev)
    of = F.ln(ratio) if formula == "ln" else F.sqrt(ratio)
    return F.when((cur > 0) & (dev > 0), (cur - dev) * of).otherwise(F.lit(0.0))


def bin_counts(df: DataFrame, bins: Bins, by: list[str]) -> DataFrame:
    """DR01: (by..., variable, bin, count). All variables in one pass: each row becomes one array of bin numbers, and counts
    are pre-aggregated before the only shuffle, whose keys are by, variable and bin."""
    pairs = F.array(*(F.struct(F.lit(v).alias("variable"), first_bin(F.col(v), [u for u, _ in b]).cast("int").alias("bin")) for v, b in bins.items()))
    return df.select(*by, F.inline(pairs)).groupBy(*by, "variable", "bin").agg(F.count(F.lit(1)).alias("count"))


def bin_spec(df: DataFrame, bins: Bins) -> DataFrame:
    """(variable, bin, count_dev, dist_dev): the development side, a literal table of a row per bin."""
    rows = [(v, k, int(n), float(n) / max(1, sum(m for _, m in b))) for v, b in bins.items() for k, (_, n) in enumerate(b, 1)]
    return df.sparkSession.createDataFrame(rows, "variable string, bin int, count_dev long, dist_dev double")


def stability(df: DataFrame, bins: Bins, by: list[str], formula: str = "ln") -> DataFrame:
    """DR02, PL06: (by..., variable, bin, count_dev, dist_dev, count_current, dist_current, psi), a row for every bin.

    The spine is groups x bins; the specification's size is that of the configuration, so it is broadcast."""
    counts = bin_counts(df, bins, by)
    spec = F.broadcast(bin_spec(df, bins))
    groups = df.select(*by).distinct() if by else None
    spine = groups.join(spec) if groups is not None else spec
    full = spine.join(counts, [*by, "variable", "bin"], "left").withColumn("count_current", F.coalesce("count", F.lit(0)))
    share = F.try_divide(F.col("count_current").cast("double"), F.sum("count_current").over(Window.partitionBy(*by, "variable")))
    full = full.withColumn("dist_current", F.coalesce(share, F.lit(0.0)))
    return full.select(*by, "variable", "bin", "count_dev", "dist_dev", "count_current", "dist_current", stability_term(F.col("dist_current"), F.col("dist_dev"), formula).alias("psi"))


def stability_totals(report: DataFrame, by: list[str]) -> DataFrame:
    """DR03"""
    return report.groupBy(*by, "variable").agg(F.sum("psi").alias("total_psi"))


def quality_table(df: DataFrame, variables: list[str], by: list[str], percents: tuple[int, ...] = PERCENTS, accuracy: int | None = 10_000) -> DataFrame:
    """DR04, AG09: count, missing, deviation, mean, min, percentiles, max per variable. Percentiles are approximate, with bounded
    state; exact ones, for accuracy None, hold a count of every distinct value."""
    values = df.select(*by, F.inline(F.array(*(F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("x")) for v in variables))))
    shares = F.array(*(F.lit(p / 100) for p in percents))
    cut = F.percentile("x", shares) if accuracy is None else F.percentile_approx("x", shares, accuracy)
    out = values.groupBy(*by, "variable").agg(F.count(F.lit(1)).alias("count"), (F.count(F.lit(1)) - F.count("x")).alias("n_miss"), F.stddev("x").alias("std"), F.avg("x").alias("mean"), F.min("x").alias("min"), cut.alias("_p"), F.max("x").alias("max"))
    return out.select(*by, "variable", "count", "n_miss", "std", "mean", "min", *(F.get("_p", k).alias(f"p{p}") for k, p in enumerate(percents)), "max")


def gate(totals: DataFrame, threshold: float, threshold_hard: float) -> DataFrame:
    """DR05: totals with over and over_hard (both strict)."""
    return totals.withColumns({"over": F.col("total_psi") > threshold, "over_hard": F.col("total_psi") > threshold_hard})


def enforce_gate(gated: DataFrame, most: int) -> None:
    """DR05: raises if more than `most` variables are over the threshold. Reads one row."""
    n = gated.agg(F.count_if("over").alias("n")).first()["n"]
    if n > most:
        raise DriftError(f"{n} variables over the threshold, {most} allowed")


def period_change(totals: DataFrame, period: str, least: float = 0.1) -> DataFrame:
    """DR06, JN05: the change of each variable's total against its period before, (cur - prev) / prev; changed if |change| >=
    least. One window per variable in place of a self join."""
    w = Window.partitionBy("variable").orderBy(period)
    out = totals.withColumn("previous_psi", F.lag("total_psi").over(w))
    out = out.withColumn("change", F.try_divide(F.col("total_psi") - F.col("previous_psi"), F.col("previous_psi")))
    return out.withColumn("changed", F.coalesce(F.abs("change") >= least, F.lit(False)))


def width_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """AG10: equal-width bin 1..bins; values outside go to the edge bins, and lo = hi is one bin."""
    raw = F.floor((x - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins).cast("int") + 1
    return F.when(x.isNotNull(), F.least(F.greatest(F.coalesce(raw, F.lit(1)), F.lit(1)), F.lit(bins)))


def _melted(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("x")) for c in columns)))).where("x is not null")


def histogram(df: DataFrame, columns: list[str], bins: int = 10, like: DataFrame | None = None) -> DataFrame:
    """AG10: (variable, bin, count) with bounds from `like` (default: df itself). The bounds are one row per variable."""
    bounds = F.broadcast(_melted(df if like is None else like, columns).groupBy("variable").agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    binned = _melted(df, columns).join(bounds, "variable").select("variable", width_bin(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin"))
    return binned.groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("count"))


def column_drift(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10, threshold: float = 0.1, formula: str = "ln") -> DataFrame:
    """DR07: (variable, psi, overall_psi, drifted, drift_detected): each column's index with the reference's bounds, their mean,
    and whether they are over the threshold. The reference is read for the bounds and once more for the counts, which both sides
    get from one aggregate."""
    bounds = F.broadcast(_melted(reference, columns).groupBy("variable").agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    sides = _melted(reference, columns).withColumn("new", F.lit(0)).unionByName(_melted(current, columns).withColumn("new", F.lit(1)))
    binned = sides.join(bounds, "variable").select("variable", "new", width_bin(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin"))
    both = binned.groupBy("variable", "bin").agg(F.count_if(F.col("new") == 0).alias("ref"), F.count_if(F.col("new") == 1).alias("cur"))
    w = Window.partitionBy("variable")
    share = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.sum(c).over(w)), F.lit(0.0))
    terms = both.select("variable", stability_term(share("cur"), share("ref"), formula).alias("t"))
    per = terms.groupBy("variable").agg(F.sum("t").alias("psi"))
    overall = F.broadcast(per.agg(F.avg("psi").alias("overall_psi")))
    return per.join(overall).select("variable", "psi", "overall_psi", (F.col("psi") > threshold).alias("drifted"), (F.col("overall_psi") > threshold).alias("drift_detected"))


def retrain_flag(drift: DataFrame, performance: DataFrame) -> DataFrame:
    """DR08: one row: drift_detected of any variable, degraded, and whether to retrain. performance: one row with degraded."""
    one = drift.agg(F.max("drift_detected").alias("drift_detected"))
    return one.join(performance.select("degraded")).select("drift_detected", "degraded", (F.col("drift_detected") | F.col("degraded")).alias("retrain"))


def ordered_report(bins: DataFrame, by: list[str], order: str) -> DataFrame:
    """ST04: a report of bins in order, with each row's place in its part. A report has a row per bin, so one sort holds it."""
    return bins.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(order))).orderBy(*by, order)
