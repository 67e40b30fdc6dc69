"""Window aggregates of a cohort from monthly sums (FE07, FE08, JN08): the work does not grow with the number of windows.

History is summed by key and month, combined before its one shuffle. Along a key's months, running sums give the sum of any
window as a difference of two of them, and minima and maxima of 1, 2, 4, ... months give those of any window from two that cover
it. A key's months travel as one row, as long as a history has months; the cohort meets it by key, whatever the windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def month_number(c: Column) -> Column:
    return (F.year(c) * 12 + F.month(c)).cast("int")


def monthly_sums(hist: DataFrame, key: str, snapshot: str, variables: list[str]) -> DataFrame:
    """(k, m, rows, then n, s, a, q, lo, hi of each variable): rows, values, sum, mean, squared deviations, minimum and maximum of a key's month.
    Sums of decimals and integers stay what they are, so that their differences are exact."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, v in enumerate(variables):
        x = F.col(v).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.sum(v).alias(f"s{i}"), F.avg(x).alias(f"a{i}"), (F.var_pop(x) * F.count(x)).alias(f"q{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    return hist.groupBy(F.col(key).alias("k"), month_number(F.col(snapshot)).alias("m")).agg(*aggs)


def month_index(monthly: DataFrame, n_variables: int, longest: int, extremes: bool = True) -> DataFrame:
    """(k, months): for each key an array, in order of m, of m, running sums of rows and, of each variable, of values, sums and of first and
    second moments about the key's mean, and the extremes of the 1, 2, 4, ... months that begin there."""
    every, so_far = Window.partitionBy("k"), Window.partitionBy("k").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    mu = {f"mu{i}": F.coalesce(F.try_divide(F.sum(F.col(f"s{i}").cast("double")).over(every), F.sum(f"n{i}").over(every)), F.lit(0.0)) for i in range(n_variables)}
    rows = monthly.withColumns(mu)
    cols = [F.sum("rows").over(so_far).alias("rows")]
    for i in range(n_variables):
        n, s, m = F.col(f"n{i}"), F.coalesce(f"s{i}", F.lit(0).cast(monthly.schema[f"s{i}"].dataType)), F.col(f"mu{i}")
        second = F.when(n > 0, F.col(f"q{i}") + n * (F.col(f"a{i}") - m) ** 2).otherwise(0.0)
        cols += [F.sum(n).over(so_far).alias(f"n{i}"), F.sum(s).over(so_far).alias(f"s{i}"), F.sum(s.cast("double") - n * m).over(so_far).alias(f"c{i}"), F.sum(second).over(so_far).alias(f"d{i}")]
        spans = [Window.partitionBy("k").orderBy("m").rowsBetween(0, (1 << level) - 1) for level in range(longest.bit_length() if extremes else 0)]
        if spans:
            cols += [F.array(*(F.min(f"lo{i}").over(w) for w in spans)).alias(f"lo{i}"), F.array(*(F.max(f"hi{i}").over(w) for w in spans)).alias(f"hi{i}")]
    return rows.select("k", F.struct("m", *cols).alias("month")).groupBy("k").agg(F.array_sort(F.collect_list("month")).alias("months"))


def _once(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """df with more columns, which are computed once each: as a generator's one row, while plain columns would be written out again
    wherever they are used."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in cols.items())))))


def _window(i: int, w: int, functions: tuple[str, ...]) -> dict[str, Column]:
    """The functions of variable i over a window w, from the running sums at its end and before its start, and from the extremes of
    the two spans of 2**level months that cover it."""
    top, below = F.col("_top"), F.col(f"_below{w}")
    gain = lambda c: F.coalesce(top[f"{c}{i}"] - below[f"{c}{i}"], top[f"{c}{i}"])
    level, n = F.col(f"_level{w}"), F.when(F.col(f"_level{w}").isNotNull(), gain("n"))
    out = {"sum": F.when(n > 0, gain("s")), "mean": F.when(n > 0, gain("s").cast("double") / n), "count": F.coalesce(n, F.lit(0))}
    out["std"] = F.when(n > 1, F.sqrt(F.greatest((gain("d") - gain("c") ** 2 / n) / (n - 1), F.lit(0.0))))
    for name, pick, c in (("min", F.least, "lo"), ("max", F.greatest, "hi")):
        if name in functions:
            out[name] = F.when(n > 0, pick(*(F.get(F.col(f"_{span}{w}")[f"{c}{i}"], level) for span in ("from", "to"))))
    return {f: out[f] for f in functions}


def cohort_windows(
    cohort: DataFrame, hist: DataFrame, key: str, vintage: str, snapshot: str, variables: list[str], windows: list[int], functions: tuple[str, ...] = ("mean", "sum", "min", "max", "std"), lag: int = 1
) -> DataFrame:
    """FE07: the cohort's rows that have history in the longest window, with <function>_<variable>_<w>m over the months lag .. w before
    the vintage; functions: mean, sum, min, max, std, count. As window_aggregates() over cohort_history(), without its rows. Sums of
    doubles are exact to about 1e-15 of a key's sum over all months, deviations to about 1e-7 of its spread over all months."""
    if lag < 1:
        raise ValueError("a window ends before the vintage")
    longest = max(windows)
    index = month_index(monthly_sums(hist, key, snapshot, variables), len(variables), longest, bool({"min", "max"} & set(functions)))
    index = index.select(F.col("k").alias(key), F.col("months").alias("_months"))
    out = cohort.join(index, key).withColumn("_v", month_number(F.col(vintage)))
    place = lambda bound: F.size(F.filter("_months", lambda x: x["m"] < bound))
    # The months from v - w on, and those before v - lag + 1.
    places = {"_hi": place(F.col("_v") - lag + 1), "_all": place(F.col("_v") - (longest + lag - 1))} | {f"_lo{w}": place(F.col("_v") - w) for w in sorted(set(windows))}
    out = _once(out, places).where("_hi > _all")
    # The level is null where a window has no months.
    levels = {f"_level{w}": F.when(F.col("_hi") > F.col(f"_lo{w}"), F.floor(F.log2(F.col("_hi") - F.col(f"_lo{w}")) + 1e-9).cast("int")) for w in sorted(set(windows))}
    out = _once(out, levels)
    month = lambda at: F.get("_months", at)
    ends = {"_top": month(F.col("_hi") - 1)}
    for w in sorted(set(windows)):
        ends |= {f"_below{w}": month(F.col(f"_lo{w}") - 1), f"_from{w}": month(F.col(f"_lo{w}")), f"_to{w}": month(F.col("_hi") - F.pow(F.lit(2), F.col(f"_level{w}")).cast("int"))}
    out = _once(out, ends)
    cols = {f"{f}_{v}_{w}m": c for i, v in enumerate(variables) for w in windows for f, c in _window(i, w, functions).items()}
    return out.select(*(F.col(f"`{c}`") for c in cohort.columns), *(c.alias(n) for n, c in cols.items()))
