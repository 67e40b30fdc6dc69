"""Literal cases, properties and plans of the operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import expressions as X
from sluice.operators import arrival as AR
from sluice.operators import drift as DR
from sluice.operators import features as FE
from sluice.operators import models as ML
from sluice.operators import quality as DQ
from sluice.operators import scores as SP
from sluice.sources import tables as T
from sluice.streaming import streams as ST

EMAIL = r"^[\w.+-]+@[\w-]+\.[\w.]+$"


@pytest.mark.parametrize(
    ("rows", "schema", "rule", "score", "failed"),
    [
        ([(7, None), (8, "Oslo"), (9, "Lima"), (10, None)], "id int, name string", {"type": "completeness", "column": "name", "threshold": 0.8}, 0.5, 2),
        ([(40,), (40,), (41,), (42,), (42,)], "id int", {"type": "uniqueness", "columns": ["id"]}, 0.6, 2),
        ([(0,), (12,), (-5,), (830,)], "amount int", {"type": "range", "column": "amount", "min_value": 0}, 0.75, 1),
        ([("no address",), ("x.y@z.example",), ("@z.example",), ("q+1@w-w.example.net",)], "e string", {"type": "pattern", "column": "e", "pattern": EMAIL}, 0.5, 2),
        ([("a@b.co",), ("c@d.org",), ("e@f.net",)], "e string", {"type": "regex", "column": "e", "regex": EMAIL}, 1.0, 0),
    ],
)
def test_quality_literals(spark, rows, schema, rule, score, failed):
    r = DQ.validate(spark.createDataFrame(rows, schema), [DQ.rule_from_config(rule)]).first()
    assert (r["score"], r["failed_records"], r["passed"]) == (score, failed, failed == 0)


def test_quality_contract(spark):
    df = spark.createDataFrame([(6, None, 61)], "id int, name string, age int")
    with pytest.raises(DQ.QualityError, match="Data quality validation failed"):
        DQ.enforce(df, [DQ.Rule("n", "completeness", ("name",))])
    assert DQ.validate(df, [DQ.Rule("n", "completeness", ("name",), enabled=False)]).count() == 0
    with pytest.raises(ValueError, match="Column not found"):
        DQ.validate(df, [DQ.Rule("n", "completeness", ("nope",))])
    with pytest.raises(ValueError, match="Unknown rule type"):
        DQ.rule_from_config({"type": "magic", "column": "id"})
    empty = DQ.validate(df.limit(0), [DQ.Rule("n", "completeness", ("id",))]).first()
    assert not empty["passed"] and empty["details"] == "Dataset is empty"


def test_schema_check(spark):
    got = DQ.check_schema(spark.createDataFrame([(1, "a")], "id int, x string"), [("id", "int"), ("y", None)])
    assert got == {"missing": ["y"], "extra": ["x"], "wrong_type": [], "score": 0.5, "passed": False}


def test_rules_take_one_aggregate(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rules = [DQ.Rule(f"r{k}", "range", ("o_totalprice",), low=float(k)) for k in range(20)]
    plan = DQ.validate(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan


def test_stability_of_same_data_is_zero(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("double").alias("x"))
    assert DR.column_drift(df, df, ["x"]).first()["psi"] == 0
    report = DR.stability(df, {"x": [(24.0, 25), (49.0, 25), (74.0, 25), (0.0, 25)]}, [])
    assert report.agg(F.sum("count_current")).first()[0] == 1000
    assert abs(report.agg(F.sum("psi")).first()[0]) < 1e-12
    with pytest.raises(DR.DriftError):
        DR.enforce_gate(spark.createDataFrame([("a", 0.5)], "variable string, total_psi double").transform(lambda d: DR.gate(d, 0.1, 0.2)), 0)


def test_null_goes_to_the_last_bin(spark):
    df = spark.createDataFrame([(None,), (1.0,), (9.0,)], "x double")
    assert [r[0] for r in df.select(X.first_bin(F.col("x"), [5.0, 8.0, 9.0])).collect()] == [3, 1, 3]


def test_arrival_gate(spark):
    counts = spark.createDataFrame([("t", "2024-01-31", 5)], "table_name string, partition string, count long").withColumn("partition", F.col("partition").cast("date"))
    v = AR.expected_partitions(counts, "t", "2024-02-10", 2)
    assert [(str(r[1]), r[2]) for r in v.orderBy("partition").collect()] == [("2024-01-31", 5), ("2024-02-29", 0)]
    with pytest.raises(AR.ArrivalError):
        AR.enforce_arrival(v)
    assert AR.with_zero_row(counts.limit(0), "u").first()["count"] == 0


def test_ntile_has_no_single_partition_of_rows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    got = SP.global_ntile(df, "o_totalprice", "o_orderkey", {"t": 7})
    sizes = [r["count"] for r in got.groupBy("t").count().orderBy("t").collect()]
    n = df.count()
    assert sizes == [n // 7 + (k < n % 7) for k in range(7)]


def test_split_is_disjoint_and_stable(spark):
    a = FE.hash_split(spark.range(5000), "id").where("is_test")
    assert 800 < a.count() < 1200
    assert a.exceptAll(FE.hash_split(spark.range(5000).repartition(3), "id").where("is_test")).count() == 0


def test_hash_share_equals_the_big_number(spark):
    import hashlib

    got = {r[0]: r[1] for r in spark.range(50).select("id", X.hash_share(F.col("id"))).collect()}
    assert got == {i: int(hashlib.md5(str(i).encode()).hexdigest(), 16) % 1000 for i in range(50)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    path = f"file://{tmp_path}/t"
    T.write(df, path, partition_by=["p"])
    T.overwrite_partitions(spark.createDataFrame([(9, "b")], "x int, p string"), path, ["p"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (9, "b")]
    T.write(df, f"file://{tmp_path}/c", fmt="csv")
    assert T.read(spark, f"file://{tmp_path}/c", "csv").count() == 2
    T.write(df.limit(1), f"file://{tmp_path}/j", fmt="json")
    assert T.read(spark, f"file://{tmp_path}/j", "json").count() == 1
    calls = []
    make = lambda: calls.append(1) or df
    for _ in range(2):
        assert T.materialize(spark, f"file://{tmp_path}/m", make).count() == 2
    assert calls == [1]
    T.create_partitioned_table(spark, "made", [("x", "int")], [("p", "string")])
    T.overwrite_partitions(df, "made", ["p"])
    assert T.read_table(spark, "made").count() == 2
    T.write_table(df, "other", mode="overwrite")
    assert spark.table("other").count() == 2


def test_model_round_trip(spark, tmp_path):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 > 9).cast("int").alias("y"))
    m = ML.train_classifier(df, ["x"], "y", depths=(2,), iterations=(3,), folds=2)
    ML.save(m, f"file://{tmp_path}/m")
    scored = ML.score(df, ML.load(f"file://{tmp_path}/m"), "id").join(df, "id")
    assert ML.auc(scored, "y", "p").first()[0] == 1.0
    assert ML.area_under_pr(scored, "y", "p") > 0.99
    assert ML.feature_importance(m, ["x"]).first()["importance"] == 1.0


def test_late_rows_are_counted(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    rows = lambda ts: spark.createDataFrame([(t, 1.0) for t in ts], "t string, value double").select(F.col("t").cast("timestamp").alias("ts"), "value")
    dropped = 0
    for k, ts in enumerate((["2024-01-01 00:00:00", "2024-01-03 00:00:00"], ["2024-01-05 00:00:00"], ["2024-01-01 01:00:00", "2024-01-06 00:00:00"])):
        rows(ts).coalesce(1).write.parquet(f"{src}/b{k}")
        stream = ST.stream_source(spark, f"{src}/*", "ts timestamp, value double")
        q = ST.run_stream(stream, lambda s: ST.windowed(s, "ts", [], "value", "1 day"), out, f"{tmp_path}/ck")
        q.awaitTermination()
        dropped += ST.dropped_late(q)
    assert dropped >= 1


def test_auc_and_tiles_at_size(spark):
    """3,000,000 rows with other columns beside, without reuse of exchanges: equal to the exact figures."""
    n = 3_000_000
    x = F.pmod(F.xxhash64("id"), F.lit(900_001)).cast("double")
    df = spark.range(n).select("id", F.when(F.col("id") % 1000 == 0, None).otherwise(x).alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 3).cast("int").alias("y"), F.lit("other").alias("_part"))
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        tiles = SP.global_ntile(df, "x", "id", {"quartile": 4, "decile": 10}).select("id", "x", "y", "quartile", "decile").toPandas()
        auc = ML.auc(df.where("x is not null"), "y", "x").first()["auc"]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    tiles = tiles.sort_values(["x", "id"], na_position="first", ignore_index=True)
    for name, k in (("quartile", 4), ("decile", 10)):
        q, r = divmod(n, k)
        want = np.repeat(np.arange(1, k + 1), [q + (i < r) for i in range(k)])
        assert (tiles[name].to_numpy() == want).all()
    known = tiles[tiles.x.notna()]
    rank, pos = known.x.rank().to_numpy(), (known.y == 1).to_numpy()
    want = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert abs(auc - want) < 1e-9


def test_windows_cover_months_one_to_w(spark):
    rows = spark.createDataFrame([(1, m, float(10**m)) for m in range(6)], "k int, months_back int, x double")
    got = FE.window_aggregates(rows, ["k"], ["x"], [1, 3], ("sum", "mean")).first()
    assert (got["sum_x_1m"], got["sum_x_3m"], got["mean_x_3m"]) == (10.0, 1110.0, 370.0)


def test_accents(spark):
    df = spark.createDataFrame([("\u00c9t\u00e9 \u00df \u00d8re \u0141\u00f3d\u017a \u1ebf e\u0301",), (None,)], "s string")
    X.register_sql_functions(spark)
    assert [r[0] for r in df.select(X.strip_accents(F.col("s"))).collect()] == ["ete ss ore lodz e e", ""]
    assert [r[0] for r in df.selectExpr("strip_accents(s)").collect()] == ["ete ss ore lodz e e", ""]


def test_fill_missing_sketches(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 3.0), ("a", None), ("b", None)], "g string, v double")
    for exact in (False, True):
        got = FE.fill_missing(df.withColumn("w", F.col("v")), {"v": ("median", 0.0), "w": ("mode", 0.0)}, ["g"], exact=exact).collect()
        assert [(r["v"], r["w"]) for r in got if r["g"] == "b"] == [(3.0, 3.0)]


def test_similar_items_in_blocks(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("u"), F.pmod(F.xxhash64("id"), F.lit(60)).alias("i"))
    whole, split = ({tuple(r) for r in ML.similar_items(rows, "u", "i", 0.1, block_items=k).collect()} for k in (1000, 7))
    assert whole == split and len(whole) > 100


def test_calendar(spark):
    assert [str(r[0]) for r in AR.day_spine(spark, "2024-02-28", "2024-03-01").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    for end in ("2024-02-28", "2024-02-01"):
        with pytest.raises(ValueError, match="start"):
            AR.day_spine(spark, "2024-02-28", end)
    assert AR.window_list(12, 3) == [3, 6, 9, 12] and AR.window_list(2, 3) == []
    assert AR.process_month("2024-01-15") == "202312"


def test_drift_of_an_empty_side(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    assert DR.column_drift(df, df.limit(0), ["x"]).first()["psi"] == 0
