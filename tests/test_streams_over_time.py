"""Keyed state, states that merge and late rows: streams in several batches against the same data as one table."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import quality as DQ
from sluice.operators.quality import Rule
from sluice.streaming import streams as ST
from sluice.streaming import velocity
from sluice.streaming.velocity import event_velocity, figures

SCHEMA = "event_id long, ts timestamp, user_id long, value double"
START = datetime(2024, 1, 1)


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def random_events(seed, n, days):
    rnd = random.Random(seed)
    return [(i, START + timedelta(seconds=rnd.randrange(days * 86_400) // 600 * 600), rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice([None, rnd.randrange(100) / 4])) for i in range(n)]


def test_figures_by_hand():
    ts = np.array([0, 0, 3_600_000_000, 3_600_000_001], dtype=np.int64)
    got = figures(ts, np.array([1.0, np.nan, 2.0, 4.0]), np.array([0, 2, 3]))
    assert got["count_1h"].tolist() == [1, 2, 2] and got["sum_1h"].tolist() == [1.0, 3.0, 6.0] and got["avg_7d"].tolist() == [1.0, 1.5, 7 / 3]


def test_velocity_of_a_stream_is_that_of_the_table(spark, tmp_path):
    """Three runs from one checkpoint; events are out of order within the delay, and state is carried, given and dropped."""
    rows = sorted(random_events(1, 900, 20), key=lambda r: r[1] + timedelta(hours=random.Random(r[0]).random() * 5))
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for k in range(3):
        write(spark, rows[k * 300 : (k + 1) * 300], src)
        ST.run_stream(ST.stream_source(spark, src, SCHEMA), lambda s: event_velocity(s, "user_id", "ts", "value", "event_id", "6 hours"), out, f"{tmp_path}/ck", keyed_state=True).awaitTermination()
    columns = [f"{f}_{n}" for n in ("1h", "24h", "7d") for f in ("count", "sum", "avg")]
    got = {r.event_id: [None if r[c] is None else round(r[c], 6) for c in columns] for r in spark.read.parquet(out).collect()}
    whole = event_velocity(spark.createDataFrame(rows, SCHEMA), "user_id", "ts", "value", "event_id")
    end = max(r[1] for r in rows) - timedelta(hours=6)
    want = {r.event_id: [None if r[c] is None else round(r[c], 6) for c in columns] for r in whole.where(F.col("ts") < F.lit(end)).collect()}
    assert got == want and len(got) > 600


def test_velocity_of_keys_that_share_a_bucket(spark, tmp_path, monkeypatch):
    """Many keys in two buckets of state, events without a value, and a second run from the checkpoint"""
    monkeypatch.setattr(velocity, "BUCKETS", 2)
    rows = [(k, START + timedelta(minutes=37 * k), k % 23, None if k % 7 == 0 else float(k % 11)) for k in range(600)]
    for part in (rows[:350], rows[350:]):
        write(spark, part, f"{tmp_path}/in")
        ST.run_stream(ST.stream_source(spark, f"{tmp_path}/in", SCHEMA), lambda s: event_velocity(s, "user_id", "ts", "value", "event_id"), f"{tmp_path}/out", f"{tmp_path}/ck", keyed_state=True).awaitTermination()
    columns = ["event_id", "user_id", *(f"{f}_{n}" for n in ("1h", "24h", "7d") for f in ("count", "sum"))]
    whole = event_velocity(spark.createDataFrame(rows, SCHEMA), "user_id", "ts", "value", "event_id").where(F.col("ts") < F.lit(rows[-1][1] - timedelta(hours=1)))
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))
    state = spark.read.format("statestore").option("stateVarName", "events").option("flattenCollectionTypes", "false").load(f"{tmp_path}/ck")
    assert state.count() <= 2


def test_late_rows_come_back_by_id(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    parts = [[(1, at(0), 1, 1.0), (2, at(50), 1, 1.0)], [(3, at(49.5), 1, 1.0), (4, at(48), 1, 1.0), (5, None, 1, 1.0), (6, at(60), 1, 1.0)], [(7, at(1), 1, 1.0), (8, at(59), 1, 1.0), (9, at(58.9), 1, 1.0)]]
    for rows in parts:
        write(spark, rows, f"{tmp_path}/in")
        for _ in range(2):  # the second run has nothing new
            ST.split_late(ST.stream_source(spark, f"{tmp_path}/in", SCHEMA), "ts", "1 hour", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    ids = lambda late: sorted(r.event_id for r in ST.rows_of_split(spark, f"{tmp_path}/out", SCHEMA, late).collect())
    assert ids(True) == [4, 7, 9] and ids(False) == [1, 2, 3, 5, 6, 8]


RULES = [
    Rule("ids", "uniqueness", ("event_id",)), Rule("pairs", "uniqueness", ("user_id", "value"), threshold=0.1), Rule("valued", "completeness", ("value",)), Rule("low", "range", ("value",), low=0.0, high=12.0),
    Rule("fresh", "freshness", ("ts",), as_of="2024-01-22 00:00:00", max_hours=48.0), Rule("off", "range", ("value",), enabled=False), Rule("far", "outlier", ("value",), max_z=1.2),
]


@pytest.mark.parametrize("exact", [True, False])
def test_rules_over_all_batches_are_those_of_the_table(spark, tmp_path, exact):
    rows = random_events(2, 3000, 20)
    again = rows[:7]
    for part in (rows[:1000], rows[1000:], again):
        write(spark, part, f"{tmp_path}/in")
        ST.validate_stream(ST.stream_source(spark, f"{tmp_path}/in", SCHEMA), RULES, f"{tmp_path}/out", f"{tmp_path}/ck", exact).awaitTermination()
    got = {r.rule: r for r in ST.stream_results(spark, f"{tmp_path}/out", RULES, exact).collect()}
    want = {r.rule: r for r in DQ.validate(spark.createDataFrame(rows + again, SCHEMA), RULES).collect()}
    assert set(got) == set(want) == {"ids", "pairs", "valued", "low", "fresh", "far"}
    for name in ("valued", "low", "fresh", *(("ids", "pairs") if exact else ())):
        assert got[name] == want[name]
    assert got["far"].passed_records == pytest.approx(want["far"].passed_records, rel=0.01)
    assert got["ids"].passed_records == pytest.approx(3000, rel=0.02)
    if exact:
        assert not got["ids"].passed and got["ids"].failed_records == 7


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    states = lambda rows: DQ.state_of(spark.createDataFrame(rows, SCHEMA), RULES)
    for rows in (random_events(3, 50, 2), random_events(4, 60, 2)):
        for name, state in states(rows).items():
            state.write.mode("overwrite").parquet(f"{tmp_path}/{name}/batch=0")
    assert {r.total for r in ST.stream_results(spark, str(tmp_path), RULES).collect()} == {60}


def test_no_rows_fail_every_rule(spark):
    state = DQ.state_of(spark.createDataFrame([], SCHEMA), RULES)
    out = DQ.merged_results(lambda name: state[name], RULES).collect()
    assert len(out) == 6 and not any(r.passed for r in out) and {r.details for r in out} == {"Dataset is empty"}
