"""Transaction, rating and cohort features (FE, WN01-WN06, JN02, JN04, JN08, AG05, AG12, AG13)."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.functions.expressions import clear_names, ordered_case
from sluice.operators.ranks import digest, nth_digest

#: name -> seconds, and the row counts that "frame='rows'" takes in their place.
WINDOWS = {"7d": (7 * 86_400, 10_080), "24h": (86_400, 1_440), "1h": (3_600, 60)}
AMOUNTS = [(50.0, "small"), (500.0, "medium"), (2000.0, "large")]


def transaction_features(tx: DataFrame, customer: str, merchant: str, amount: str, ts: str, tx_id: str, label: str, frame: str = "time", leave_one_out: bool = False, slice_days: int = 28) -> DataFrame:
    """FE01, WN01-WN05: rolling count, sum, mean and deviation per customer, z-score, calendar flags, amount class, days since
    the first transaction, the customer's mean, and the merchant's label rate and count.

    A customer may have any share of the rows: with frame "time" (ranges of seconds, both ends in) windows are taken within slices
    of slice_days of a customer's time, to which the rows of the longest window before them are copied, so that a customer's slices
    are dealt to many tasks. The customer's own figures are an aggregate, combined before its shuffle, which meets the rows slice
    by slice where they are. With frame "rows" (counts of rows by (ts, tx_id)) a customer is one task's. A merchant may have any share
    too: its figures are an aggregate joined back. Means are sums over counts: exact for decimal amounts."""
    longest = max(width for width, _ in WINDOWS.values())
    length = slice_days * 86_400
    if length < longest:
        raise ValueError("a slice must hold the longest window")
    at, own, key, again, total, n_all, first = clear_names(tx, "at", "own", "key", "again", "total", "n", "first")
    x, seconds = F.col(amount), F.col(ts).cast("timestamp").cast("long")
    number = F.floor(seconds / length) if frame == "time" else F.lit(0).cast("long")
    rows = tx.withColumns({at: seconds, own: number})
    # Structs hold nulls as values: unknown customers and times are groups like others.
    slices = rows.groupBy(F.struct(F.col(customer).alias("c"), F.col(own).alias("s")).alias(key)).agg(F.count(x).alias(n_all), F.sum(x).alias(total), F.min(ts).alias(first))
    customers = slices.groupBy(F.struct(F.col(f"{key}.c").alias("c")).alias(own)).agg(F.sum(n_all).alias(n_all), F.sum(total).alias(total), F.min(first).alias(first))
    of_slice = slices.select(key, F.struct(F.col(f"{key}.c").alias("c")).alias(own)).join(customers, own).drop(own)
    if frame == "time":
        halo = F.when(F.pmod(F.col(at), F.lit(length)) >= length - longest, F.array(F.col(own), F.col(own) + 1)).otherwise(F.array(own))
        rows = rows.withColumn(again, F.explode(halo))
    else:
        rows = rows.withColumn(again, F.col(own))
    rows = rows.withColumn(key, F.struct(F.col(customer).alias("c"), F.col(again).alias("s")))
    by_time, by_row = Window.partitionBy(key).orderBy(at), Window.partitionBy(key).orderBy(F.col(ts), F.col(tx_id))
    cols: dict[str, Column] = {}
    for name, (width, n_rows) in WINDOWS.items():
        w = by_time.rangeBetween(-width, 0) if frame == "time" else by_row.rowsBetween(-n_rows, 0)
        cols |= {f"count_{name}": F.count(x).over(w), f"sum_{name}": F.sum(x).over(w), f"avg_{name}": F.try_divide(F.sum(x).over(w).cast("double"), F.count(x).over(w)), f"std_{name}": F.stddev(x).over(w)}
    out = rows.withColumns(cols).where(F.col(again).eqNullSafe(F.col(own))).join(of_slice, key)
    out = out.withColumns({"customer_avg": F.try_divide(F.col(total).cast("double"), F.col(n_all)), "days_since_first": F.datediff(F.col(ts), F.col(first))}).drop(at, own, key, again, total, n_all, first)
    shop, labels = clear_names(tx, "shop", "labels")
    shops = tx.groupBy(F.col(merchant).alias(shop)).agg(F.count(F.lit(1)).alias("merchant_count"), F.sum(label).alias(labels))
    out = out.join(shops, F.col(merchant).eqNullSafe(F.col(shop)))
    n, s = F.col("merchant_count"), F.col(labels)
    out = out.withColumn("merchant_rate", F.try_divide(s - F.col(label), n - 1) if leave_one_out else s / n).drop(shop, labels)
    z = F.when(F.col("std_7d") > 0, (x.cast("double") - F.col("avg_7d")) / F.col("std_7d")).otherwise(0.0)
    return out.withColumns({"z_score": z, "hour": F.hour(ts), "day_of_week": F.dayofweek(ts), "is_weekend": F.dayofweek(ts).isin(1, 7).cast("int"), "amount_class": ordered_case(x, AMOUNTS, "very_large")})


def decayed_rating(df: DataFrame, rating: str, ts: str, as_of: str, scale: float = 365.0) -> DataFrame:
    """FE04: rating * exp(-days / scale), days before as_of."""
    return df.withColumn("decayed_rating", F.col(rating) * F.exp(-F.datediff(F.lit(as_of).cast("date"), F.col(ts)) / F.lit(scale)))


def frequent_only(ratings: DataFrame, user: str, item: str, least_user: int, least_item: int) -> DataFrame:
    """JN02, AG06: ratings whose user and item both have enough ratings, counted before any filter."""
    ok = lambda c, k: ratings.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).select(c)
    return ratings.join(ok(user, least_user), user, "left_semi").join(ok(item, least_item), item, "left_semi")


def user_profiles(ratings: DataFrame, user: str, category: str, rating: str, categories: list[str], least: int = 2) -> DataFrame:
    """FE05, AG05: a user's mean rating of each category with at least `least` ratings, 0 elsewhere. The categories are given,
    so that pivoting takes no job of its own."""
    means = ratings.groupBy(user, category).agg(F.avg(rating).alias("m"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return means.groupBy(user).pivot(category, categories).agg(F.first("m")).fillna(0.0)


def user_statistics(ratings: DataFrame, user: str, rating: str) -> DataFrame:
    """FE05, AG01: without categories."""
    return ratings.groupBy(user).agg(F.count(F.lit(1)).alias("n_ratings"), F.avg(rating).alias("avg_rating"), F.stddev(rating).alias("std_rating"), F.min(rating).alias("min_rating"), F.max(rating).alias("max_rating"))


def item_profiles(items: DataFrame, ratings: DataFrame, item: str, user: str, rating: str) -> DataFrame:
    """FE06, JN01, PRJ07: mean, deviation, popularity and users of each item; zeros for items without ratings."""
    stats = ratings.groupBy(item).agg(F.avg(rating).alias("avg_rating"), F.stddev(rating).alias("std_rating"), F.count(F.lit(1)).alias("popularity"), F.count_distinct(user).alias("unique_users"))
    return items.join(stats, item, "left").fillna(0, ["avg_rating", "std_rating", "popularity", "unique_users"])


def attach_accounts(cohort: DataFrame, source: DataFrame, key: str, account: str, date: str, after: str, before: str) -> DataFrame:
    """JN04, PRJ09: the cohort with the accounts active in [after, before), distinct."""
    active = source.where((F.col(date) >= F.lit(after).cast("date")) & (F.col(date) < F.lit(before).cast("date"))).select(key, account).distinct()
    return cohort.join(active, key, "left")


def cohort_bounds(cohort: DataFrame, vintage: str, n_months: int, lag: int) -> DataFrame:
    """JN04: one row (lower, upper): what snapshots a cohort needs; upper is exclusive."""
    shift = lambda c, k: F.date_sub(F.add_months(F.date_add(c, 1), k), 1)
    one = cohort.agg(F.min(vintage).cast("date").alias("lo"), F.max(vintage).cast("date").alias("hi"))
    return one.select(shift(F.col("lo"), -(n_months + lag - 1)).alias("lower"), shift(F.col("hi"), 1).alias("upper"))


def months_between_ends(later: Column, earlier: Column) -> Column:
    return (F.year(later) * 12 + F.month(later) - F.year(earlier) * 12 - F.month(earlier)).cast("int")


def cohort_history(cohort: DataFrame, hist: DataFrame, key: str, vintage: str, snapshot: str, n_months: int, lag: int = 0) -> DataFrame:
    """JN08: history rows of a cohort member from the n_months months up to lag months before its vintage, with months_back.

    The range is turned into an equality: each cohort row is repeated for its months, so that key and month carry the join,
    whatever the number of snapshots of one key. The repeated cohort is not broadcast: its estimated size leaves the repetition out."""
    spine = cohort.withColumn("_m", F.explode(F.sequence(F.lit(lag), F.lit(n_months + lag - 1))))
    spine = spine.withColumn("_month", F.trunc(F.add_months(F.trunc(vintage, "MM"), -F.col("_m")), "MM"))
    rows = hist.withColumn("_month", F.trunc(snapshot, "MM"))
    return spine.hint("merge").join(rows, [key, "_month"]).withColumnRenamed("_m", "months_back").drop("_month")


_FUNCTIONS: dict[str, Callable[[Column], Column]] = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "std": F.stddev}


def window_aggregates(rows: DataFrame, keys: list[str], variables: list[str], windows: list[int], functions: tuple[str, ...] = ("mean", "sum", "min", "max", "std")) -> DataFrame:
    """FE07: columns <function>_<variable>_<w>m over the months 1 .. w before the vintage, all in one aggregate."""
    aggs = [_FUNCTIONS[f](F.when(F.col("months_back").between(1, w), F.col(v))).alias(f"{f}_{v}_{w}m") for v in variables for w in windows for f in functions]
    return rows.groupBy(*keys).agg(*aggs)


def window_ratios(df: DataFrame, variables: list[str], windows: list[int], function: str = "mean") -> DataFrame:
    """FE08: ratio_<variable>_<w1>m_<w2>m for each w1 < w2; null where the longer window is 0."""
    pairs = [(a, b) for i, a in enumerate(sorted(windows)) for b in sorted(windows)[i + 1 :]]
    return df.withColumns({f"ratio_{v}_{a}m_{b}m": F.try_divide(F.col(f"{function}_{v}_{a}m"), F.col(f"{function}_{v}_{b}m")) for v in variables for a, b in pairs})


def fill_missing(df: DataFrame, methods: dict[str, tuple[str, float]], keys: list[str], exact: bool = False) -> DataFrame:
    """FE09: variable -> (method, constant). Methods: constant, or mean, median, mode of the group, then of all, then the
    constant. Statistics are aggregates joined back, so no group is held in one window. Median and mode are approximate, from
    sketches of bounded size, unless exact ones are asked for, whose state grows with the distinct values."""
    frequent = lambda v: F.get(F.expr(f"approx_top_k(`{v}`, 1, 10000) FILTER (WHERE `{v}` IS NOT NULL)"), 0)["item"]
    stats = {"mean": F.avg, "median": (lambda v: F.percentile(v, 0.5)) if exact else (lambda v: F.percentile_approx(v, 0.5, 10_000)), "mode": F.mode if exact else frequent}
    asked = {v: m for v, (m, _) in methods.items() if m != "constant"}
    if asked:
        df = df.join(df.groupBy(*keys).agg(*(stats[m](v).alias(f"_g_{v}") for v, m in asked.items())), keys, "left")
        df = df.join(F.broadcast(df.agg(*(stats[m](v).alias(f"_a_{v}") for v, m in asked.items()))))
    filled = {v: F.coalesce(F.col(v), *([F.col(f"_g_{v}"), F.col(f"_a_{v}")] if v in asked else []), F.lit(c)) for v, (_, c) in methods.items()}
    return df.withColumns(filled).drop(*(f"_{a}_{v}" for v in asked for a in "ga"))


def months_on_book(df: DataFrame, first_seen: str, vintage: str, windows: dict[str, int]) -> DataFrame:
    """FE10: mob, the months from first_seen to vintage; a feature of a window longer than that is null. windows: feature ->
    months."""
    out = df.withColumn("mob", months_between_ends(F.col(vintage), F.col(first_seen)))
    return out.withColumns({f: F.when(F.col("mob") >= w, F.col(f)) for f, w in windows.items()})


def group_by_config(df: DataFrame, keys: list[str], features: list[tuple[str, str, str]]) -> DataFrame:
    """AG12: features: (variable, function, name)."""
    known = {"count": F.count, "first": F.first, "last": F.last, **_FUNCTIONS}
    return df.groupBy(*keys).agg(*(known[f](F.col(v)).alias(n) for v, f, n in features))


def pivot_by_month(df: DataFrame, keys: list[str], variables: list[str], n_months: int) -> DataFrame:
    """AG13: <variable>_<k> for months_back k = 0 .. n_months - 1, one aggregate."""
    return df.groupBy(*keys).agg(*(F.max(F.when(F.col("months_back") == k, F.col(v))).alias(f"{v}_{k}") for v in variables for k in range(n_months)))


def melt(df: DataFrame, ids: list[str], values: list[str], var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """PRJ10"""
    return df.unpivot(ids, values, var_name, value_name)


def columns_like(df: DataFrame, dtype: str | None = None, prefix: str | None = None, exclude: tuple[str, ...] = ()) -> list[str]:
    """PRJ12: names by type, prefix and exclusion."""
    return [n for n, t in df.dtypes if (dtype is None or t == dtype) and (prefix is None or n.startswith(prefix)) and n not in exclude]


def union_all(frames: list[DataFrame]) -> DataFrame:
    """SE01"""
    return reduce(DataFrame.unionByName, frames)


def rank_in_group(df: DataFrame, group: str, by: list[Column], name: str = "rank") -> DataFrame:
    """WN06: row numbers; by must order without ties."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*by)))


def share_bound(share: float) -> str:
    """The 128-bit number, as 32 hexadecimal digits, below which that share of all digests is. The share is taken as it is written:
    0.0005 is 5 in 10,000."""
    if not 0 <= share <= 1:
        raise ValueError(f"a share must be from 0 to 1, not {share}")
    return f"{int(Fraction(str(share)) * (1 << 128)):032x}"


def in_share(key: Column, share: float) -> Column:
    """Whether the md5 of a key, all 128 bits of it, is below the share; null keys are like empty ones."""
    bound = share_bound(share)
    return F.lit(True) if len(bound) > 32 else digest(key) < bound


def hash_split(df: DataFrame, key: str, test_share: float = 0.2) -> DataFrame:
    """PRJ16: is_test by the md5 of the key: the same rows on every run."""
    return df.withColumn("is_test", in_share(F.col(key), test_share))


def hash_sample(df: DataFrame, key: str, share: float) -> DataFrame:
    """PRJ14: a sample by the md5 of the key, the same on every run, of any share."""
    return df.where(in_share(F.col(key), share))


def rebalance(df: DataFrame, label: str, key: str, most: float = 10.0, to: float = 5.0) -> DataFrame:
    """PRJ15: with more than `most` zeros for a one, exactly floor(to * ones) zeros are kept, those of the smallest md5 of the key, at any
    ratio of the classes; zeros whose keys are equal to the first left out are left out too. Without ones, or with fewer zeros, df
    itself. Rows with other labels go. Three small aggregates decide when it is called; df's rows are only filtered."""
    ones, zeros = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    out = df.where(F.col(label).isin(0, 1))
    bound = nth_digest(df.where(F.col(label) == 0), key, zeros, int(to * ones)) if ones and zeros > most * ones else None
    return out if bound is None else out.where((F.col(label) == 1) | (digest(F.col(key)) < bound))


def surrogate_id(df: DataFrame, name: str) -> DataFrame:
    """PRJ17: numbers that no two rows share. They depend on how the rows are scanned: write them before they are used twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def distinct_sorted(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """AG08: the group's distinct values as a sorted array; as large as a group has distinct values."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_set(value)).alias(name))
