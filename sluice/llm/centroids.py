"""Centroid clustering on integers: rounds of assignment to the nearest centroid, and of exact means.

Vectors of `dims` finite entries become integers floor(factor * entry). The first centroids are the k vectors whose salted
hash of the id is smallest. Each round assigns every vector to its nearest centroid (squared Euclidean distance, of equals
the smaller number) and replaces each centroid that has vectors by their mean, rounded down; then vectors are assigned once more.

Most distances are not computed. Vectors are stored with their leading coordinates in a rotated frame (the principal axes of a
sample, as many as hold the share `held` of its variance) and the norm of what the other coordinates hold. For a vector and a centroid, the squared distance of the
leading coordinates plus the squared difference of the two norms is no more than their squared distance, as the rotation
keeps lengths and two residuals differ by at least the difference of their norms. The centroid of the smallest bound gives a
distance in integers; only centroids whose bound doesn't exceed it are verified, in integers. Leading coordinates are stored
in 32 bits, so bounds are loosened by more than the rounding can be: the rotation, and the sample it is fitted on (SAMPLE
vectors of smallest hash at most), decide how many centroids are verified, never on a result.

Each round is one scan of the stored vectors, of which at most k rows of sums leave a task; k centroids are all that the
driver holds. Copies of one vector, however many, are rows like others.

Defined cases: null vectors, vectors with null or non-finite entries or of another length are left out; with fewer than k
vectors there are as many centroids as vectors; null ids come last in the order of hashes, vectors of one id in the order of
their entries; repeated rows are vectors of their own and get the same cluster, the one of the smaller number where they are
centroids twice; an empty table gives no rows; extra columns are not read; entries whose scaled value is vectors.LARGEST or
more are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, stored
from sluice.llm.vectors import finite, scaled

#: Vectors that the rotation is fitted on, at most.
SAMPLE = 4096
#: Rows that are compared with all centroids at once.
_ROWS = 2048


def _smallest(rows: DataFrame, k: int, salt: str) -> list[list[float]]:
    """Up to max(k, SAMPLE) vectors, those of smallest hash first. Hashes above a threshold that about as many pass are not sorted."""
    n, most = rows.count(), max(k, SAMPLE)
    hashed = rows.select(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).alias("h"), "v")
    share = min(1.0, 2 * most / max(n, 1))
    few = hashed.where(F.col("h") < f"{int(share * 0xFFFFFFFF):08x}") if share < 1 else hashed
    best = lambda df: df.orderBy(F.col("h").asc_nulls_last(), "v").limit(most).select("v").collect()
    found = best(few)
    found = best(hashed) if share < 1 and len(found) < most else found  # ids that repeat can leave too few
    return [list(r.v) for r in found]


class Frame:
    """A rotated frame: the mean of a sample and its leading principal axes."""

    def __init__(self, sample: np.ndarray, held: float) -> None:
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        values, axes = np.linalg.eigh(centred.T @ centred)
        sums = np.cumsum(values[::-1])
        self.axes = axes[:, ::-1][:, : 1 + int((sums < held * sums[-1]).sum())]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leading coordinates of rows, and the norms of their residuals."""
        centred = x - self.mean
        at = centred @ self.axes
        rest = centred - at @ self.axes.T
        return at, np.sqrt((rest * rest).sum(axis=1))


def nearest(x: np.ndarray, at: np.ndarray, rest: np.ndarray, centroids: np.ndarray, frame: Frame) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of rows x, placed in the frame at `at` and `rest`, and how many distances were computed."""
    c_at, c_rest = frame.place(centroids.astype(np.float64))
    here, there = np.c_[at.astype(np.float64), rest], np.c_[c_at, c_rest]
    own, other = (here * here).sum(axis=1), (there * there).sum(axis=1)
    low = np.sqrt(np.maximum(own[:, None] + other[None, :] - 2 * here @ there.T, 0))
    slack = 1e-6 * (np.sqrt(own)[:, None] + np.sqrt(other)[None, :]) + 1e-9  # of 32-bit coordinates, and of the cancellation above
    bound = np.maximum(low - slack, 0) ** 2
    first = bound.argmin(axis=1)
    reach = ((x - centroids[first]) ** 2).sum(axis=1)
    rows, cols = np.nonzero(bound <= reach[:, None] * (1 + 1e-12))
    exact = np.full(bound.shape, np.iinfo(np.int64).max, dtype=np.int64)
    exact[rows, cols] = ((x[rows] - centroids[cols]) ** 2).sum(axis=1)
    cluster = exact.argmin(axis=1)
    return cluster, exact[np.arange(len(x)), cluster], len(rows) + len(x)


def _placed(rows: DataFrame, dims: int, factor: int, frame: Frame) -> DataFrame:
    """(id, x, lead, rest): the integers, the leading coordinates (32 bits) and the residual's norm, as stored."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = scaled(batch.column(1), dims, factor)
            at, rest = frame.place(x.astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column(0), _packed(x.astype("<i4")), _packed(at.astype("<f4")), pa.array(rest)], names=["id", "x", "lead", "rest"])

    return rows.mapInArrow(place, f"id {rows.schema['id'].dataType.simpleString()}, x binary, lead binary, rest double")


def _packed(m: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    width = m.shape[1] * m.dtype.itemsize
    ends = np.arange(len(m) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(m))])


def _read(col: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=kind).reshape(len(col), -1)


def _assigned(placed: DataFrame, centroids: np.ndarray, frame: Frame, with_sums: bool) -> DataFrame:
    """(id, cluster, distance) of every row; or, with sums, (cluster, n, sums) of what each task has read."""
    k, dims = centroids.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                b = batch.slice(start, _ROWS)
                x = _read(b.column(1), "<i4").astype(np.int64)
                cluster, distance, _ = nearest(x, _read(b.column(2), "<f4"), b.column(3).to_numpy(), centroids, frame)
                if with_sums:
                    mine = cluster == np.arange(k)[:, None]
                    n += mine.sum(axis=1)
                    sums += (mine.astype(np.float64) @ x).astype(np.int64)  # exact: below 2**53
                else:
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, type=pa.int32()), pa.array(distance)], names=["id", "cluster", "distance"])
        if with_sums and n.any():
            has = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(has, type=pa.int32()), pa.array(n[has]), pa.array(list(sums[has]), type=pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    if with_sums:
        return placed.mapInArrow(assign, "cluster int, n long, sums array<long>")
    return placed.mapInArrow(assign, f"id {placed.schema['id'].dataType.simpleString()}, cluster int, distance long")


def cluster(
    df: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, factor: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", salt: str = "2:", held: float = 0.9, on_round: Callable[[np.ndarray], None] | None = None
) -> DataFrame:
    """A row per vector: (id_col, cluster, distance, cluster_inertia, inertia, centroid array<long>). on_round: is given the
    centroids of each assignment."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where(finite(F.col("v")) & (F.size("v") == dims))
    best = _smallest(rows, k, salt)
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not best:
        return df.sparkSession.createDataFrame([], schema)
    sample = scaled(pa.array(best, type=pa.list_(pa.float64())), dims, factor)
    centroids, frame = sample[:k].copy(), Frame(sample.astype(np.float64), held)
    placed = stored(_placed(rows, dims, factor, frame), "vectors-placed")
    for _ in range(rounds):
        if on_round:
            on_round(centroids)
        sums = _assigned(placed, centroids, frame, with_sums=True).groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(dims)))
        centroids = centroids.copy()
        for c, n, *s in sums.collect():  # k rows at most
            centroids[c] = [v // n for v in s]
    if on_round:
        on_round(centroids)
    found = stored(_assigned(placed, centroids, frame, with_sums=False), "vectors-assigned")
    discard(placed)
    inertia = dict(tuple(r) for r in found.groupBy("cluster").agg(F.sum("distance")).collect())
    each = [(c, d, sum(inertia.values()), centroids[c].tolist()) for c, d in inertia.items()]
    of = df.sparkSession.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    out = found.join(F.broadcast(of), "cluster")  # k rows at most
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
