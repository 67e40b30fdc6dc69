"""Global ranks, hash shares and joins of similar sets: exact against plain code, and in proportion where a key is hot."""

import hashlib
import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sluice.operators import features as FE
from sluice.operators import models as ML
from sluice.operators import ranks as RK
from sluice.operators import similarity as SM
from sluice.sources.tables import discard


def order(v):
    return (v is not None, v is not None and math.isnan(v), v if v is not None and not math.isnan(v) else 0)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_order_statistics_with_ties_nulls_and_nan(spark, kind):
    rnd = random.Random(3)
    values = [rnd.choice([None, float("nan"), 1.5, 1.5, 1.5, rnd.random() * 9]) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, place double").withColumn("key", F.col("id").cast(kind)).repartition(5)
    want = sorted(((v, i if kind == "long" else str(i)) for i, v in enumerate(values)), key=lambda r: (order(r[0]), r[1]))
    got = RK.order_statistics(df, ["place", "key"], [0, 17, 1999, 3998, 3999, 4000])
    assert set(got) == {0, 17, 1999, 3998, 3999} and all(str(got[r]) == str(want[r]) for r in got)
    tiles = {r.key: r.t for r in RK.global_ntile(df, "place", "key", {"t": 9}).collect()}
    sizes = [4000 // 9 + (k < 4000 % 9) for k in range(9)]
    expected = [t for t, n in enumerate(sizes, 1) for _ in range(n)]
    assert [tiles[k] for _, k in want] == expected


def test_ranges_grow_with_the_rows_and_cut_ties(spark):
    """A third of the rows has one score; no range is much larger than asked for."""
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("s"))
    ranged = RK.range_sorted(df, ["s", "id"], most_rows=2000)
    sizes = [r["count"] for r in ranged.rows.groupBy(ranged.part()).count().collect()]
    assert len(sizes) >= 25 and max(sizes) < 6000 and ranged.n == 60_000
    discard(ranged.rows)


def test_more_tiles_than_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 1.0)], "id long, s double")
    assert {r.id: r.t for r in RK.global_ntile(df, "s", "id", {"t": 5}).collect()} == {2: 1, 1: 2}
    assert RK.global_ntile(df.limit(0), "s", "id", {"t": 5}).count() == 0
    assert RK.curve_areas(df.limit(0).withColumn("y", F.lit(1)), "y", "s").first() == (None, None)


def test_areas_under_curves(spark):
    rnd = random.Random(5)
    rows = [(rnd.random() < 0.2, rnd.randrange(40) / 40 if rnd.random() < 0.9 else None) for _ in range(3000)]
    df = spark.createDataFrame([(int(y), s, 7) for y, s in rows], "y int, _value double, _part int")
    auc, pr = RK.curve_areas(df, "y", "_value").first()
    low = lambda s: -1.0 if s is None else s
    pos, neg = ([low(s) for y, s in rows if bool(y) == k] for k in (True, False))
    assert auc == pytest.approx(sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg), abs=1e-12)
    points = []
    for v in sorted({low(s) for _, s in rows}, reverse=True):
        tp, fp = sum(p >= v for p in pos), sum(n >= v for n in neg)
        points.append((tp / len(pos), tp / (tp + fp)))
    points = [(0.0, points[0][1]), *points]
    assert pr == pytest.approx(sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:], strict=False)), abs=1e-12)
    assert ML.auc(df, "y", "_value").columns == ["auc"]
    assert pr == pytest.approx(ML.area_under_pr(df.fillna(-1.0).withColumn("s", F.col("_value")), "y", "s"), abs=1e-6)


# --- hash shares ------------------------------------------------------------------------------------------------------


def md5(x):
    return int(hashlib.md5(str(x).encode()).hexdigest(), 16)


@pytest.mark.parametrize("share", [0, 1e-5, 0.0005, 0.1, 0.3333, 1])
def test_samples_of_any_share(spark, share):
    got = {r.id for r in FE.hash_sample(spark.range(100_010), "id", share).collect()}
    assert got == {i for i in range(100_010) if md5(i) < share * 2**128}
    with pytest.raises(ValueError, match="share"):
        FE.hash_sample(spark.range(1), "id", 1.5)


def test_null_keys_are_in_one_part(spark):
    df = spark.createDataFrame([(None,), ("a",)], "k string")
    assert FE.hash_split(df, "k").where("is_test is null").count() == 0


@pytest.mark.parametrize("ones, zeros", [(10, 100_000), (10, 30_000), (1, 10_000), (3, 29), (3, 30), (3, 31), (0, 50), (50, 0)])
def test_rebalanced_to_the_row(spark, ones, zeros):
    df = spark.range(ones + zeros).select("id", (F.col("id") < ones).cast("int").alias("y"), F.lit("x").alias("digest"))
    got = {r.id for r in FE.rebalance(df, "y", "id").collect()}
    kept = sorted(range(ones, ones + zeros), key=md5)[: 5 * ones if ones and zeros > 10 * ones else zeros]
    assert got == {*range(ones), *kept}


def test_rebalanced_with_one_key_for_a_third(spark):
    df = spark.range(9010).select((F.col("id") < 10).cast("int").alias("y"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    zeros = sorted(md5(-1 if i % 3 == 0 else i) for i in range(10, 9010))
    bound = zeros[50]
    assert FE.rebalance(df, "y", "k").where("y = 0").count() == sum(z < bound for z in zeros)


# --- similar sets -----------------------------------------------------------------------------------------------------


def plain_pairs(sets, least, kind):
    out = {}
    for a, b in combinations(sorted(sets), 2):
        k, na, nb = len(sets[a] & sets[b]), len(sets[a]), len(sets[b])
        s = k / math.sqrt(na * nb) if kind == "cosine" else k / (na + nb - k)
        if k and s >= least:
            out[a, b] = (k, round(s, 9))
    return out


@pytest.mark.parametrize("kind", ["cosine", "jaccard"])
@pytest.mark.parametrize("least", [0.12, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])
def test_similar_sets_are_all_found(spark, kind, least):
    rnd = random.Random(f"{kind}{least}")
    sets = {}
    for i in range(150):
        if i % 3 == 2:  # near a set before: some features less, some more
            base = set(sets[rnd.randrange(i)])
            sets[i] = set(rnd.sample(sorted(base), max(1, len(base) - rnd.randrange(3)))) | set(rnd.sample(range(60), rnd.randrange(3)))
        else:
            sets[i] = {min(59, int(rnd.expovariate(0.06))) for _ in range(rnd.choice([1, 2, 3, 8, 20, 60]))}
    rows = [(i, f) for i, s in sets.items() for f in s] * 2 + [(None, 1), (5, None)]
    df = spark.createDataFrame(rows, "x long, f long").repartition(4)
    got = {(r.a, r.b): (r.common, round(r.similarity, 9)) for r in SM.similar_sets(df, "x", "f", least, kind, block=7).collect()}
    assert got == plain_pairs(sets, least, kind) and (least == 1.0 or len(got) > 20)


def hot(spark, n):
    """n sets of four own features and one that all have."""
    return spark.range(n).select(F.col("id").alias("x"), F.explode(F.array(*(F.col("id") * 4 + k for k in range(4)), F.lit(-1))).alias("f"))


@pytest.mark.parametrize("kind", ["cosine", "jaccard"])
def test_a_feature_of_all_makes_no_candidates(spark, kind):
    planted = spark.createDataFrame([(90_000 + i, f) for i in range(2) for f in (10**6, 10**6 + 1, 10**6 + 2, -1)], "x long, f long")
    for n in (500, 2000):
        rows = hot(spark, n).unionByName(planted)
        met = SM.candidates(SM.sized(rows, "x", "f"), SM.Measure(kind, 0.7)).collect()
        assert [tuple(r) for r in met] == [(90_000, 90_001)]
        assert [(r.a, r.b, r.common) for r in SM.similar_sets(rows, "x", "f", 0.7, kind).collect()] == [(90_000, 90_001, 4)]


def test_a_hot_attribute_makes_no_classes_meet(spark):
    items = spark.range(3000).select(F.col("id").alias("item"), (F.col("id") % 1000).alias("p"), (F.col("id") % 1000 + 5000).alias("q"), F.lit("all").alias("r"))
    got = ML.content_similarity(items, "item", ["p", "q", "r"], 0.7).collect()
    assert len(got) == 1000 and all(r.class_a == r.class_b and r.similarity == 1 for r in got)
