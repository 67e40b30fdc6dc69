"""Queries that run a stream to its end and read what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.quality import Rule
from sluice.plans.base import query, r4, table
from sluice.sources.tables import shared_folder
from sluice.streaming import streams as ST
from sluice.streaming.velocity import event_velocity

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.stream_source(spark, sf_dir, EVENTS, pathGlobFilter="events.parquet")


def _ran(spark: SparkSession, sf_dir: str, transform) -> DataFrame:
    at = shared_folder(spark)
    ST.run_stream(events(spark, sf_dir), transform, f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/out")


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS s, event_type, count(*) AS n, sum(value) AS t FROM events GROUP BY ALL)
SELECT s::VARCHAR AS window_start, event_type, n, round(t, 2) AS total FROM w WHERE s + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def str_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR01, STR02, SRC10, SNK09"""
    out = _ran(spark, sf_dir, lambda s: ST.windowed(s, "ts", ["event_type"], "value", "1 day"))
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("""WITH g AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER w >= INTERVAL 6 HOURS, true)::INT AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g), e AS (SELECT user_id, min(ts) AS b, max(ts) + INTERVAL 6 HOURS AS f, count(*) AS n FROM s GROUP BY user_id, k)
SELECT user_id, b::VARCHAR AS session_start, n FROM e WHERE f <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def str_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR03"""
    out = _ran(spark, sf_dir, lambda s: ST.sessions(s, "ts", "user_id", "6 hours"))
    text = F.regexp_replace(F.date_format("session_start", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+$", "")
    return out.select("user_id", F.when(F.date_format("session_start", "SSSSSS") == "000000", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss")).otherwise(text).alias("session_start"), "n")


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events")
def str_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR04: every event comes twice, and once stays"""
    twice = lambda s: ST.dedup(s.withColumn("again", F.explode(F.array(F.lit(1), F.lit(2)))), "ts", ["event_id"])
    return _ran(spark, sf_dir, twice).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("SELECT 'value_range' AS rule, count(*) FILTER (value BETWEEN 0 AND 50) AS passed_records, count(*) AS total, 0::BIGINT AS batch FROM events")
def str_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR05"""
    at = shared_folder(spark)
    ST.validate_batches(events(spark, sf_dir), [Rule("value_range", "range", ("value",), low=0.0, high=50.0)], f"{at}/out", f"{at}/checkpoint").awaitTermination()
    return r4(spark.read.parquet(f"{at}/out").select("rule", "passed_records", "total", "batch"))


_VELOCITY = ", ".join(f"count(value) OVER w{n} AS count_{n}, round(sum(value) OVER w{n}, 3) AS sum_{n}" for n in ("1h", "24h", "7d"))
_FRAMES = ", ".join(f"w{n} AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {i} PRECEDING AND CURRENT ROW)" for n, i in (("1h", "1 HOUR"), ("24h", "24 HOURS"), ("7d", "7 DAYS")))


@query(f"""SELECT * FROM (SELECT user_id, event_id, epoch_us(ts) AS us, {_VELOCITY} FROM events WINDOW {_FRAMES}) WHERE us < (SELECT epoch_us(max(ts)) // 1000 * 1000 FROM events) - 3600000000""")
def str_event_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR06: each event's figures of an hour, a day and seven days, by keyed state"""
    at = shared_folder(spark)
    ST.run_stream(events(spark, sf_dir), lambda s: event_velocity(s, "user_id", "ts", "value", "event_id"), f"{at}/out", f"{at}/checkpoint", keyed_state=True).awaitTermination()
    out = spark.read.parquet(f"{at}/out")
    return out.select("user_id", "event_id", F.unix_micros("ts").alias("us"), *(F.col(f"count_{n}") if f == "count" else (F.round(f"sum_{n}", 3) + F.lit(0.0)).alias(f"sum_{n}") for n in ("1h", "24h", "7d") for f in ("count", "sum")))


def _in_parts(spark: SparkSession, sf_dir: str, start) -> None:
    """The events as three files' worth that come one after the other: by thirds of the time, but every fiftieth comes with the last;
    start: runs the stream of a folder to its end."""
    e = table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = e.agg(F.min(us).alias("lo"), F.max(us).alias("hi"))
    third = F.when(F.col("event_id") % 50 == 0, 2).otherwise(F.least(F.floor((us - F.col("lo")) * 3 / (F.col("hi") - F.col("lo"))), F.lit(2)))
    dealt = e.join(F.broadcast(bounds)).withColumn("part", third)
    at = shared_folder(spark, "arriving")
    for k in range(3):
        dealt.where(F.col("part") == k).select(e.columns).write.mode("append").parquet(at)
        start(ST.stream_source(spark, at, EVENTS)).awaitTermination()


_PARTS = """WITH b AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
p AS (SELECT e.*, CASE WHEN event_id % 50 = 0 THEN 2 ELSE least(floor((epoch_us(ts) - lo) * 3 / (hi - lo)), 2) END AS part FROM events e, b) """


@query(_PARTS + "SELECT event_id, (part > 0 AND ts < (SELECT max(ts) FROM p o WHERE o.part < p.part) - INTERVAL 1 HOUR)::BIGINT AS late FROM p")
def str_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR07: what came after the watermark, by id"""
    at = shared_folder(spark)
    _in_parts(spark, sf_dir, lambda s: ST.split_late(s, "ts", "1 hour", f"{at}/split", f"{at}/checkpoint"))
    late, rest = (ST.rows_of_split(spark, f"{at}/split", EVENTS, k).select("event_id", F.lit(int(k)).cast("long").alias("late")) for k in (True, False))
    return late.unionByName(rest)


_STREAM_RULES = [Rule("one_event_each", "uniqueness", ("event_id",)), Rule("user_and_type", "uniqueness", ("user_id", "event_type"), threshold=0.2), Rule("has_value", "completeness", ("value",)), Rule("value_range", "range", ("value",), low=0.0, high=50.0, threshold=0.5), Rule("kinds", "pattern", ("event_type",), pattern="^[a-z]+$")]


@query("""WITH e AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 50 = 0), n AS (SELECT count(*) AS n FROM e),
r AS (SELECT 'one_event_each' AS rule, (SELECT count(DISTINCT event_id) FROM e) AS passed_records, 1.0 AS t UNION ALL SELECT 'user_and_type', (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM e)), 0.2
UNION ALL SELECT 'has_value', (SELECT count(value) FROM e), 1.0 UNION ALL SELECT 'value_range', (SELECT count(*) FILTER (value BETWEEN 0 AND 50) FROM e), 0.5 UNION ALL SELECT 'kinds', (SELECT count(*) FILTER (regexp_matches(event_type, '^[a-z]+$')) FROM e), 1.0)
SELECT rule, passed_records, n AS total, round(passed_records / n, 4) AS score, passed_records / n >= t AS passed FROM r, n""")
def str_quality_all_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR05: rules judged over all batches together; every fiftieth event comes again in a later one"""
    at, e = shared_folder(spark), table(spark, sf_dir, "events")
    for part in (e, e.where("event_id % 50 = 0")):
        part.write.mode("append").parquet(f"{at}/in")
        ST.validate_stream(ST.stream_source(spark, f"{at}/in", EVENTS), _STREAM_RULES, f"{at}/state", f"{at}/checkpoint").awaitTermination()
    return r4(ST.stream_results(spark, f"{at}/state", _STREAM_RULES).select("rule", "passed_records", "total", "score", "passed"))
