"""Arrival of snapshot partitions: count history, expected partitions, growth bands, trend (DR10-DR13, WN08-WN10, ST01)."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.functions.expressions import month_end


class ArrivalError(ValueError):
    """Expected partitions are empty."""


def partition_counts(df: DataFrame, table: str, partition: Column, daily_to_month: bool = False) -> DataFrame:
    """DR10, AG07: (table_name, partition, count). Daily partitions are summed at their month's end. Rows are counted map-side;
    only partition counts are shuffled."""
    p = F.last_day(partition) if daily_to_month else partition
    return df.groupBy(p.cast("date").alias("partition")).agg(F.count(F.lit(1)).alias("count")).select(F.lit(table).alias("table_name"), "partition", "count")


def campaign_counts(df: DataFrame, table: str, campaign: str) -> DataFrame:
    """DR10, PRJ08: counts by a text partition; null is CNA."""
    return df.groupBy(F.coalesce(F.col(campaign), F.lit("CNA")).alias("campaign")).agg(F.count(F.lit(1)).alias("count")).select(F.lit(table).alias("table_name"), "campaign", "count")


def day_spine(spark: SparkSession, start: str, end: str, name: str = "day") -> DataFrame:
    """Calendar: a row for every day from start to end, both in; an error unless start is before end."""
    if not date.fromisoformat(start) < date.fromisoformat(end):
        raise ValueError("the start must be before the end")
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(name))


def with_every_day(counts: DataFrame) -> DataFrame:
    """Calendar, JN03: the counts of each table's partitions with a row of 0 for every day without one, from its first day to its last."""
    spine = counts.groupBy("table_name").agg(F.min("partition").alias("a"), F.max("partition").alias("b")).select("table_name", F.explode(F.sequence("a", "b")).alias("partition"))
    return spine.join(counts, ["table_name", "partition"], "left").fillna(0, ["count"])


def window_list(n_months: int, period: int) -> list[int]:
    """Calendar, FE07: the windows of whole periods in n_months: 12 and 3 give 3, 6, 9 and 12."""
    return list(range(period, n_months + 1, period))


def process_month(day: str | None = None) -> str:
    """Calendar: the month before a day's (today's by default), as yyyyMM."""
    first = (date.fromisoformat(day) if day else date.today()).replace(day=1)
    return f"{first - timedelta(days=1):%Y%m}"


def newest(counts: DataFrame, n: int) -> DataFrame:
    """ST01: the n newest partitions of one table."""
    return counts.orderBy(F.desc("partition")).limit(n)


def skip_newest(counts: DataFrame, lag: int, periods: int) -> DataFrame:
    """WN09: of each table, partitions ranked lag + 1 .. lag + periods from the newest."""
    w = Window.partitionBy("table_name").orderBy(F.desc("partition"))
    return counts.withColumn("_r", F.row_number().over(w)).where((F.col("_r") > lag) & (F.col("_r") <= lag + periods)).drop("_r")


def history(counts: list[DataFrame], pivot: str, lag: int, periods: int) -> DataFrame:
    """DR10, SE03: the tables' counts with cohort date and window bounds, month ends before pivot. A table without rows gets one
    row of count 0."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (skip_newest(c, lag, periods) for c in counts))
    day = F.lit(pivot).cast("date")
    return every.withColumns({"cohort_date": month_end(day, -(lag + 1)), "window_start": month_end(day, -(lag + 1)), "window_end": month_end(day, -(periods + lag))})


def with_zero_row(counts: DataFrame, table: str) -> DataFrame:
    """DR10: counts, or one row (table, null, 0) where there are none."""
    zero = counts.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(table).alias("table_name"), F.lit(None).cast("date").alias("partition"), F.lit(0).cast("long").alias("count"))
    return counts.unionByName(zero)


def expected_partitions(counts: DataFrame, table: str, pivot: str, periods: int, lag: int = 0, kind: str = "month_end", day: int = 1) -> DataFrame:
    """DR11, JN03: (table_name, partition, count, arrived): a row for every expected date, count 0 where it is missing.

    kind: month_end; fixed_day (that day of the month); month_start; monthly_any (a month's rows under any date). The spine has
    `periods` rows from a sequence; one grouped count joins to it."""
    i = F.explode(F.sequence(F.lit(0), F.lit(periods - 1))).alias("i")
    spine = counts.sparkSession.range(1).select(i).select(F.add_months(F.trunc(F.lit(pivot).cast("date"), "MM"), -(F.col("i") + lag)).alias("m"))
    when = {"month_end": F.last_day("m"), "fixed_day": F.date_add("m", day - 1), "month_start": F.col("m"), "monthly_any": F.col("m")}[kind]
    have = counts.select((F.trunc("partition", "MM") if kind == "monthly_any" else F.col("partition")).alias("partition"), "count").groupBy("partition").agg(F.sum("count").alias("count"))
    out = spine.select(when.alias("partition")).join(have, "partition", "left")
    return out.select(F.lit(table).alias("table_name"), "partition", F.coalesce("count", F.lit(0)).alias("count"), (F.coalesce("count", F.lit(0)) > 0).alias("arrived"))


def on_demand(df: DataFrame, table: str) -> DataFrame:
    """DR11: a table without periods has arrived if it has rows; one row."""
    return df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(table).alias("table_name"), F.lit(None).cast("date").alias("partition"), "count", (F.col("count") > 0).alias("arrived"))


def enforce_arrival(validation: DataFrame) -> None:
    """DR11: raises if a partition has no rows; names the first hundred."""
    empty = validation.where("not arrived").select("table_name", F.col("partition").cast("string")).limit(100).collect()
    if empty:
        raise ArrivalError("empty partitions: " + ", ".join(f"{r[0]}/{r[1]}" for r in empty))


def growth_bands(counts: DataFrame) -> DataFrame:
    """DR12, WN08, WN10: (table_name, partition, count, ratio, band) of each table's newest partition: its count against the one
    before, green within 0.75..1.25, yellow within 0.5..1.75, else red; grey without one before."""
    w = Window.partitionBy("table_name").orderBy("partition")
    out = counts.withColumns({"ratio": F.try_divide(F.col("count").cast("double"), F.lag("count").over(w)), "_last": F.lead("partition").over(w).isNull()})
    r = F.col("ratio")
    band = F.when(r.isNull(), "grey").when(r.between(0.75, 1.25), "green").when(r.between(0.5, 1.75), "yellow").otherwise("red")
    return out.where("_last").select("table_name", "partition", "count", "ratio", band.alias("band"))


def trend(counts: DataFrame) -> DataFrame:
    """DR13: (table_name, slope, intercept) of counts over days since 1970."""
    x = F.unix_date("partition").cast("double")
    y = F.col("count").cast("double")
    return counts.groupBy("table_name").agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
