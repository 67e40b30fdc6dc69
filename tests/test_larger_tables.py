"""What only larger tables or rarer values show: shapes of plans, and texts of numbers."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import features as FE
from sluice.operators import models as ML
from sluice.operators import quality as DQ
from sluice.operators import scores as SP
from sluice.operators import similarity as SM


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cohort_history_is_not_broadcast(spark):
    """A cohort repeated for its months is estimated as if it were not."""
    cohort = spark.createDataFrame([(1, "1998-06-30")], "k long, vintage string").withColumn("vintage", F.col("vintage").cast("date"))
    hist = spark.createDataFrame([(1, "1998-05-03", 2.0), (1, "1998-06-03", 4.0)], "k long, snapshot string, x double").withColumn("snapshot", F.col("snapshot").cast("date"))
    rows = FE.cohort_history(cohort, hist, "k", "vintage", "snapshot", 12, lag=1)
    assert "Broadcast" not in plan(rows)
    assert [(r.months_back, r.x) for r in rows.collect()] == [(1, 2.0)]


def test_scores_are_written_as_plain_digits(spark):
    values = [-0.0, 0.0, 0.0001, -0.00003, 0.00001, 1234.5, -0.05, 12345678.5, 1e7]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert [r[0] for r in df.select(SP.decimal_text(F.col("v"))).collect()] == ["-0.0", "0.0", "0.0001", "-0.0", "0.0", "1234.5", "-0.05", "12345678.5", "10000000.0"]


@pytest.mark.parametrize(("few", "kind", "least"), [(512, "cosine", 0.55), (512, "jaccard", 0.3), (0, "cosine", 0.3), (0, "jaccard", 0.25), (0, "cosine", 0.6), (0, "jaccard", 0.7)])
def test_similar_sets_by_every_way(spark, monkeypatch, few, kind, least):
    """Products of matrices where features are few, lists and candidates where they are not: with blocks of a few rows, all as plain sets say."""
    monkeypatch.setattr(SM, "FEW", few)
    monkeypatch.setattr(SM, "_BLOCK", 7)
    rng = np.random.default_rng(5)
    sets = {k: frozenset(map(int, rng.choice(20, size=rng.integers(1, 9)))) for k in range(60)} | {k: frozenset({1, 2, 3}) for k in range(60, 65)}
    rows = spark.createDataFrame([(k, f) for k, s in sets.items() for f in s], "x long, f long")
    want = {}
    for a, b in combinations(sets, 2):
        c, na, nb = len(sets[a] & sets[b]), len(sets[a]), len(sets[b])
        v = c / (na * nb) ** 0.5 if kind == "cosine" else c / (na + nb - c)
        if v >= least:
            want[a, b] = (c, round(v, 9))
    got = SM.similar_sets(rows, "x", "f", least, kind, block=7).collect()
    assert len(got) == len(want) and {(r.a, r.b): (r.common, round(r.similarity, 9)) for r in got} == want


def test_boosted_trees_are_fitted_on_weighted_rows(spark, monkeypatch):
    """Equal rows of a fold reach the fits as one row with their number, in parts of a bounded number of rows."""
    seen = []

    class Spy(ML.CrossValidator):
        def _fit(self, data):
            weight = self.getEstimator().getWeightCol()
            seen.append((data.count(), data.agg(F.sum(weight)).first()[0]))
            return super()._fit(data)

    monkeypatch.setattr(ML, "CrossValidator", Spy)
    df = spark.range(4000).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 > 4).cast("int").alias("label"))
    model = ML.train_classifier(df, ["x"], "label", depths=(1, 2), iterations=(2,), folds=2)
    assert seen == [(20, 4000.0)]
    assert model.transform(df).where("prediction <> label").count() == 0


def test_exact_profiles_are_spread_over_tasks(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("v"))
    out = DQ.profile(df, exact_distinct=True)
    assert "RoundRobinPartitioning" in plan(out) and out.first()["distinct"] == 7
