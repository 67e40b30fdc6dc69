"""Per-event velocity of a stream by keyed state (STR06): what WN02 gives for a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

from sluice.operators.features import WINDOWS

#: name -> microseconds.
_WIDTHS = {name: seconds * 1_000_000 for name, (seconds, _) in WINDOWS.items()}
_LONGEST = max(_WIDTHS.values())
#: Buckets of keys whose state is kept together. A running stream keeps to the number it was started with.
BUCKETS = 1024


def figures(ts: np.ndarray, value: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """count_, sum_ and avg_ of the windows that end at ts[at], both ends in. ts: ascending microseconds; NaN values don't count."""
    known = ~np.isnan(value)
    n, s = np.r_[0, np.cumsum(known)], np.r_[0.0, np.cumsum(np.where(known, value, 0.0))]
    hi = np.searchsorted(ts, ts[at], side="right")
    out: dict[str, np.ndarray] = {}
    for name, width in _WIDTHS.items():
        lo = np.searchsorted(ts, ts[at] - width, side="left")
        count = n[hi] - n[lo]
        total = np.where(count > 0, s[hi] - s[lo], np.nan)
        out |= {f"count_{name}": count, f"sum_{name}": total, f"avg_{name}": total / np.where(count > 0, count, 1)}
    return out


class _Velocity(StatefulProcessor):
    """The events of the longest window of a bucket of keys, and those that wait for the watermark. An event's figures are final, and given,
    when the watermark has passed it; an event-time timer does that, and another one removes the bucket when nothing can need it any more.

    A row of the state is a batch of events as the bytes of their columns, so that the state is read and written by columns, not event by event."""

    #: Columns of an event, as they are packed.
    PACKED = {"key": np.int64, "ts": np.int64, "value": np.float64, "id": np.int64, "given": np.bool_}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", ", ".join(f"{c} binary" for c in self.PACKED))

    def _packed(self, columns: dict[str, np.ndarray]) -> tuple[bytes, ...]:
        return tuple(np.asarray(columns[c], dtype=t).tobytes() for c, t in self.PACKED.items())

    def _held(self) -> dict[str, np.ndarray]:
        """All events of the bucket, by key, time and id."""
        rows = list(self.events.get()) if self.events.exists() else []
        held = {c: np.frombuffer(b"".join(bytes(r[k]) for r in rows), dtype=t) for k, (c, t) in enumerate(self.PACKED.items())}
        order = np.lexsort((held["id"], held["ts"], held["key"]))
        return {c: v[order] for c, v in held.items()}

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  Spark's names
        first = None
        for pdf in rows:
            at = pdf["us"].to_numpy()
            self.events.appendValue(self._packed({"key": pdf["key"], "ts": at, "value": pdf["value"].astype("float64"), "id": pdf["id"], "given": np.zeros(len(at))}))
            first = at.min() if first is None else min(first, at.min())
        if first is not None:
            self.handle.registerTimer(int(first) // 1000)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._held()
        ts, due = held["ts"], ~held["given"] & (held["ts"] < now)
        edges = [0, *(np.flatnonzero(np.diff(held["key"])) + 1), len(ts)]
        found = [figures(ts[a:b], held["value"][a:b], np.flatnonzero(due[a:b])) for a, b in zip(edges, edges[1:], strict=False) if due[a:b].any()]
        if found:
            yield pd.DataFrame({"key": held["key"][due], "id": held["id"][due], "us": ts[due]} | {c: np.concatenate([f[c] for f in found]) for c in found[0]})
        held["given"] = held["given"] | due
        stay = ~held["given"] | (ts >= now - _LONGEST)
        if not stay.any():
            self.events.clear()
            return
        held = {c: v[stay] for c, v in held.items()}
        self.events.put([self._packed(held)])
        waiting = held["ts"][~held["given"]]
        self.handle.registerTimer(int(waiting.min()) // 1000 if len(waiting) else (int(held["ts"].max()) + _LONGEST) // 1000 + 1)

    def close(self) -> None:
        pass


def event_velocity(df: DataFrame, key: str, ts: str, value: str, event_id: str, delay: str = "1 hour") -> DataFrame:
    """STR06: (key, event_id, ts, count_, sum_ and avg_ of 7d, 24h and 1h) of every event: the key's events in the time up to and with it,
    those of the same time included. In a batch, range windows; in a stream, keyed state: an event is given when the watermark has
    passed it, so events may come in any order within the delay, and later ones are dropped (split_late() keeps them).

    The state is the events of seven days and of the delay, kept for BUCKETS buckets of keys, as calls to the state store cost more than the
    figures do: there are a few for each bucket and batch, whatever the number of keys and events. It needs the RocksDB state store (run_stream(..., keyed_state=True)).
    Keys and ids are longs; a null value counts nowhere; rows with a null key or time are left out."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(ts).cast("timestamp").alias("at"), F.col(value).cast("double").alias("value"), F.col(event_id).cast("long").alias("id")).where("key is not null and at is not null")
    rows = rows.withColumn("us", F.unix_micros("at"))
    if df.isStreaming:
        fields = ", ".join(f"count_{n} long, sum_{n} double, avg_{n} double" for n in WINDOWS)
        found = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS))).withWatermark("at", delay).groupBy("bucket").transformWithStateInPandas(_Velocity(), f"key long, id long, us long, {fields}", "append", "EventTime")
    else:
        cols = {}
        for name, width in _WIDTHS.items():
            w = Window.partitionBy("key").orderBy("us").rangeBetween(-width, 0)
            cols |= {f"count_{name}": F.count("value").over(w), f"sum_{name}": F.sum("value").over(w), f"avg_{name}": F.avg("value").over(w)}
        found = rows.withColumns(cols)
    return found.select(F.col("key").alias(key), F.col("id").alias(event_id), F.timestamp_micros("us").alias(ts), *(F.nanvl(F.col(f"{f}_{n}"), F.lit(None).cast("double")).alias(f"{f}_{n}") if f != "count" else F.col(f"{f}_{n}") for n in WINDOWS for f in ("count", "sum", "avg")))
