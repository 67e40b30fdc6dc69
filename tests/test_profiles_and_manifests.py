"""Profiles that merge over partitions, and data that is made again when its input or its code has changed."""

import statistics

import pytest
from pyspark.sql import functions as F

from sluice.operators import profiles as PR
from sluice.sources import tables as T


def data(spark):
    return spark.range(6000).select(
        (F.col("id") % 3).alias("p"), "id", F.when(F.col("id") % 5 > 0, F.pmod(F.xxhash64("id"), F.lit(2000)) / 7.0).alias("x"), F.when(F.col("id") == 1, float("nan")).otherwise(F.col("id").cast("double")).alias("y"),
        F.concat(F.lit("v"), F.col("id") % 40).alias("s"), F.array(F.col("id") % 4).alias("a"), F.lit(None).cast("int").alias("none"),
    )


def test_merged_profile_is_that_of_the_whole(spark, tmp_path):
    df = data(spark)
    for p in (0, 1, 2, 1):  # one partition is stored twice
        PR.store_states(PR.profile_states(df.where(F.col("p") == p), F.col("p"), ["id", "x", "y", "s", "a", "none"]), str(tmp_path))
    states = PR.stored_states(spark, str(tmp_path))
    assert states.count() == 18
    got = {r["column"]: r for r in PR.merged_profile(states).collect()}
    rows = df.collect()
    for c in ("id", "x"):
        known = [float(r[c]) for r in rows if r[c] is not None]
        assert got[c]["mean"] == pytest.approx(statistics.fmean(known)) and got[c]["stddev"] == pytest.approx(statistics.stdev(known))
        assert (float(got[c]["min"]), float(got[c]["max"]), got[c]["nulls"]) == (min(known), max(known), len(rows) - len(known))
        assert got[c]["distinct"] == pytest.approx(len(set(known)), rel=0.02)
        for p in (1, 25, 50, 99):
            share = sum(v <= got[c][f"p{p}"] for v in known) / len(known)
            assert abs(share - p / 100) < 0.012
    assert (got["s"]["min"], got["s"]["max"], got["s"]["mean"], got["s"]["p50"]) == ("v0", "v9", None, None) and got["s"]["distinct"] == 40
    assert got["a"]["distinct"] == 4 and got["a"]["type"] == "array<bigint>"
    assert (got["none"]["nulls"], got["none"]["distinct"], got["none"]["completeness"], got["none"]["p1"]) == (6000, 0, 0.0, None)
    assert float(got["y"]["max"]) == 5999 and got["y"]["total"] == 6000
    by_part = PR.merged_profile(states, [F.col("part")]).where("column = 'id'").collect()
    assert {r.part: r.total for r in by_part} == {"0": 2000, "1": 2000, "2": 2000}
    history = PR.completeness_history(states).where("column = 'id'").orderBy("part").collect()
    assert [r.previous_mean for r in history] == [None, history[0].mean, history[1].mean]


def test_profile_of_nothing(spark, tmp_path):
    assert PR.profile_states(data(spark).limit(0), F.col("p")).count() == 0
    PR.store_states(PR.profile_states(data(spark).limit(0), F.col("p"), ["id"]), f"{tmp_path}/none")
    assert PR.merged_profile(spark.createDataFrame([], PR.STATE)).count() == 0


def test_made_again_when_input_or_code_change(spark, tmp_path):
    src, out, made = f"file://{tmp_path}/in", f"file://{tmp_path}/out", []
    T.write(spark.range(5), src)

    def make():
        made.append(1)
        return T.read(spark, src)

    step = lambda f=make, **k: T.materialize(spark, out, f, inputs=[src], **k).count()
    assert [step(), step(), len(made)] == [5, 5, 1]
    T.write(spark.range(2), src, mode="append")
    assert [step(), len(made)] == [7, 2]
    T.write(spark.range(7), src, mode="overwrite")  # as many rows, other files
    assert [step(), len(made)] == [7, 3]
    assert [step(version="2"), step(version="2"), len(made)] == [7, 7, 4]

    def other():
        made.append(1)
        return T.read(spark, src).where("id > 2")

    assert [step(other), step(other), len(made)] == [4, 4, 5]


def test_a_run_that_breaks_off_leaves_no_manifest(spark, tmp_path):
    src, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    T.write(spark.range(5), src)
    good = lambda: T.read(spark, src)
    T.materialize(spark, out, good, inputs=[src], version="1")
    with pytest.raises(ZeroDivisionError):
        T.materialize(spark, out, lambda: 1 // 0, inputs=[src], version="2")
    made = []
    assert T.materialize(spark, out, lambda: made.append(1) or good(), inputs=[src], version="1").count() == 5 and made == [1]


def test_folders_in_folders_and_code_inside_code(spark, tmp_path):
    T.write(spark.range(9).withColumn("p", F.col("id") % 3), f"file://{tmp_path}/in", partition_by=["p"])
    assert T.fingerprint(spark, [f"file://{tmp_path}/in"])["files"] >= 3

    def one():
        return (lambda: 1)()

    def two():
        return (lambda: 2)()

    assert T.code_version(one) != T.code_version(two) and T.code_version(one) == T.code_version(one)
