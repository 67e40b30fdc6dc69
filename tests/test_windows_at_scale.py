"""Windows from running sums of months and within slices of time: the same figures as windows taken whole."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluice.operators import features as FE
from sluice.operators.months import cohort_windows

FUNCTIONS = ("mean", "sum", "min", "max", "std")


def frames(spark, kind="double"):
    rnd = random.Random(4)
    hist = [(rnd.choice([1, 2, 3, 4, None]), date(1996 + rnd.randrange(3), 1 + rnd.randrange(12), 1 + rnd.randrange(28)), rnd.choice([None, 5.0, rnd.randrange(10_000) / 4]), float(rnd.randrange(9))) for _ in range(400)]
    hist += [(6, date(1997, 5, 3), None, 1.0), (7, date(1990, 1, 1), 3.0, 1.0)]
    cohort = [(k, date(1997 + y, m, 28)) for k in (1, 2, 3, 4, 5, 6, 7) for y in range(2) for m in (1, 6, 12)] * 2
    return spark.createDataFrame(cohort, "k int, vintage date"), spark.createDataFrame(hist, f"k int, snapshot date, x {kind}, y double") if kind == "double" else spark.createDataFrame(hist, "k int, snapshot date, x double, y double").withColumn("x", F.col("x").cast(kind))


def table(df, digits=6):
    return sorted(str([None if v is None else round(v, digits) + 0.0 if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))]) for r in df.collect())


@pytest.mark.parametrize("lag", [1, 2, 3])
def test_windows_of_months(spark, lag):
    cohort, hist = frames(spark)
    windows = [1, 2, 3, 5, 7, 12]
    cohort = cohort.withColumn("row", F.monotonically_increasing_id())
    got = cohort_windows(cohort, hist, "k", "vintage", "snapshot", ["x", "y"], windows, FUNCTIONS, lag)
    rows = FE.cohort_history(cohort, hist, "k", "vintage", "snapshot", 12, lag)
    assert table(got, 3) == table(FE.window_aggregates(rows, ["k", "vintage", "row"], ["x", "y"], windows, FUNCTIONS), 3) and got.count() > 30


def test_decimals_are_exact(spark):
    cohort, hist = frames(spark, "decimal(12, 2)")
    got = cohort_windows(cohort.distinct(), hist, "k", "vintage", "snapshot", ["x"], [4], ("sum", "count"))
    rows = FE.cohort_history(cohort.distinct(), hist, "k", "vintage", "snapshot", 4, 1)
    want = rows.groupBy("k", "vintage").agg(F.sum("x").alias("sum_x_4m"), F.count("x").alias("count_x_4m"))
    assert table(got.withColumn("sum_x_4m", F.col("sum_x_4m").cast("string"))) == table(want.withColumn("sum_x_4m", F.col("sum_x_4m").cast("string")))


def test_more_windows_shuffle_nothing_more(spark):
    cohort, hist = frames(spark)
    plan = lambda windows: cohort_windows(cohort, hist, "k", "vintage", "snapshot", ["x"], windows)._jdf.queryExecution().executedPlan().toString()
    one, many = plan([12]), plan([1, 2, 3, 4, 6, 9, 12])
    assert one.count("Exchange") == many.count("Exchange") and "explode" not in many


@pytest.fixture(scope="module")
def purchases(spark):
    """A third of the rows are one customer's, over five years; some customers, times and amounts are unknown."""
    rnd = random.Random(6)
    start = datetime(2020, 1, 1)
    rows = []
    for i in range(3000):
        at = start + timedelta(seconds=rnd.randrange(5 * 365 * 24) * 3600 if i % 3 == 0 else rnd.randrange(40 * 24) * 1800)
        rows.append((i, "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None]), rnd.choice("mnop"), rnd.choice([None, rnd.randrange(10_000)]), None if i % 101 == 0 else at, rnd.randrange(2)))
    return spark.createDataFrame(rows, "id long, cust string, shop string, cents int, ts timestamp, label int").withColumns({"amount": (F.col("cents") / 100).cast("decimal(12, 2)"), "key": F.lit(1), "again": F.lit(2), "total": F.lit(3)})


@pytest.mark.parametrize("days", [7, 28, 100])
def test_slices_change_nothing(purchases, days):
    of = lambda d: FE.transaction_features(purchases, "cust", "shop", "amount", "ts", "id", "label", slice_days=d)
    got, whole = of(days), of(36_500)
    assert got.columns == whole.columns and got.count() == 3000 and table(got) == table(whole)


def test_windows_of_slices_by_hand(purchases):
    got = {r.id: r for r in FE.transaction_features(purchases, "cust", "shop", "amount", "ts", "id", "label").collect()}
    rows = purchases.collect()
    for r in random.Random(7).sample(rows, 120):
        mine = [x for x in rows if x.cust == r.cust]
        for name, width in (("7d", timedelta(days=7)), ("24h", timedelta(days=1)), ("1h", timedelta(hours=1))):
            seen = [x.amount for x in mine if x.amount is not None and (x.ts is None if r.ts is None else x.ts is not None and r.ts - width <= x.ts <= r.ts)]
            assert (got[r.id][f"count_{name}"], got[r.id][f"sum_{name}"]) == (len(seen), sum(seen) if seen else None)
        known = [x.amount for x in mine if x.amount is not None]
        assert got[r.id].customer_avg == pytest.approx(float(sum(known)) / len(known))
        if r.ts:
            assert got[r.id].days_since_first == (r.ts.date() - min(x.ts for x in mine if x.ts).date()).days


def test_no_exchange_by_customer_alone(purchases):
    plan = FE.transaction_features(purchases, "cust", "shop", "amount", "ts", "id", "label")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(cust" not in plan
    with pytest.raises(ValueError, match="slice"):
        FE.transaction_features(purchases, "cust", "shop", "amount", "ts", "id", "label", slice_days=3)
