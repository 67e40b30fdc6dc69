"""Structured Streaming counterparts (SRC10, SNK09, STR operators). A stream is any streaming DataFrame with a timestamp."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.quality import Rule, merged_results, state_of, validate


def stream_source(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """SRC10: files of a folder, or any other streaming format."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def run_stream(source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet", keyed_state: bool = False, **trigger: object) -> StreamingQuery:
    """STR01, SNK09: source -> transform -> files; by default what is there now, then it ends. keyed_state: state of one's own making
    needs the RocksDB store; the session's choice is put back when the query has started."""
    spark, store = source.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    if keyed_state:
        spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return transform(source).writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(path)
    finally:
        spark.conf.set(store, before)


def windowed(df: DataFrame, ts: str, keys: list[str], value: str, size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """STR02, STR06: counts and sums by time window and keys; streams close windows `delay` after their end."""
    at = df.withColumn("_ts", F.col(ts).cast("timestamp"))
    at = at.withWatermark("_ts", delay) if df.isStreaming else at
    g = at.groupBy(F.window("_ts", size, slide).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "total")


def sessions(df: DataFrame, ts: str, key: str, gap: str, delay: str = "1 hour") -> DataFrame:
    """STR03: sessions of a key, ended by a gap."""
    at = df.withColumn("_ts", F.col(ts).cast("timestamp"))
    at = at.withWatermark("_ts", delay) if df.isStreaming else at
    g = at.groupBy(F.session_window("_ts", gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return g.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def dedup(df: DataFrame, ts: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """STR04: the first row of each key within the watermark; in a batch, one row of each key."""
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    return df.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay).dropDuplicatesWithinWatermark(keys).drop("_ts")


def validate_batches(source: DataFrame, rules: list[Rule], path: str, checkpoint: str) -> StreamingQuery:
    """STR05: the rules' results for each micro-batch, one partition of files per batch; a batch that runs again replaces its own."""

    def each(batch: DataFrame, number: int) -> None:
        validate(batch, rules).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def validate_stream(source: DataFrame, rules: list[Rule], path: str, checkpoint: str, exact: bool = True) -> StreamingQuery:
    """STR05: what the rules need to know of each micro-batch, in a form that merges, one partition of files a batch; a batch that runs
    again replaces its own. stream_results() judges all batches together, so that a key which two batches have is no unique one."""

    def each(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        for name, state in state_of(held, rules, exact).items():
            state.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
        held.unpersist()

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_results(spark: SparkSession, path: str, rules: list[Rule], exact: bool = True) -> DataFrame:
    """STR05: the rules' results over all batches that validate_stream() has seen, as of one table."""
    return merged_results(lambda name: spark.read.parquet(f"{path}/{name}"), rules, exact)


def split_late(source: DataFrame, ts: str, delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """STR07: every row of a stream to files under path, marked as late where it came after the watermark: its time is more than
    `delay` before the latest time of the batches before its own. No row is lost; rows_of_split() reads either part.

    The latest time of each batch is kept beside its rows and is what later batches are held against, over restarts too; a
    batch that runs again finds the same marks and replaces its own rows. A null time is never late."""
    spark = source.sparkSession
    at = F.col(ts).cast("timestamp")
    marks = "batch long, latest timestamp"

    def each(batch: DataFrame, number: int) -> None:
        seen = spark.read.schema(marks).parquet(f"{path}/marks") if number else spark.createDataFrame([], marks)
        mark = F.broadcast(seen.where(F.col("batch") < number).agg((F.max("latest") - F.expr(f"interval {delay}")).alias("_mark")))
        rows = batch.join(mark).withColumn("late", F.coalesce(at < F.col("_mark"), F.lit(False)).cast("int")).drop("_mark")
        rows.write.mode("overwrite").partitionBy("late").parquet(f"{path}/rows/batch={number}")
        own = spark.read.schema(T.StructType([*batch.schema, T.StructField("late", T.IntegerType())])).parquet(f"{path}/rows/batch={number}")
        own.agg(F.max(at).alias("latest")).select(F.lit(number).cast("long").alias("batch"), "latest").write.mode("overwrite").parquet(f"{path}/marks/mark={number}")

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rows_of_split(spark: SparkSession, path: str, schema: str | T.StructType, late: bool) -> DataFrame:
    """STR07: the rows that split_late() has marked as late, or the others, with the number of their batch."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    every = spark.read.schema(T.StructType([*fields, T.StructField("batch", T.LongType()), T.StructField("late", T.IntegerType())])).parquet(f"{path}/rows")
    return every.where(F.col("late") == int(late)).drop("late")


def score_stream(df: DataFrame, model: Transformer) -> DataFrame:
    """STR06: a fitted model over a stream."""
    return model.transform(df)


def dropped_late(query: StreamingQuery) -> int:
    """STR07: how many rows came after the watermark, over the last batches, whose progress the session keeps (100 by default).
    split_late() gives the rows themselves, over all batches."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])
