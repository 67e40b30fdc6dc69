"""Whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Vectors become integers floor(factor * entry) + offset; their sums are exact. With X the centred rows, the process makes
orthonormal v1, v2, ... (as long as a vector) and u1, u2, ... (as long as the table) with X v_j = beta_{j-1} u_{j-1} + alpha_j u_j
and X' u_j = alpha_j v_j + beta_j v_{j+1}. The bidiagonal matrix of alphas and betas has X's singular values, from which, with its
right singular vectors, come the components and their deviations.

Both products run on Spark, one after the other in one scan a step: a row's entry of u_j is needed for that row's share of X' u_j
only. Full reorthogonalisation on both sides: the v are short, and kept by the driver. A u is X times a short vector a (as all u
are in the range of X), so the driver keeps a and q = X' u instead of u; the inner product of a new X v with an old u is that of v
with the old q, and taking the old u out of the new one takes the old a out of the new a, before any row is read. No vector as long
as the table is ever stored. Where a beta vanishes (equal eigenvalues, or fewer dimensions than entries), the process goes on with a
new start that is orthogonal to all v. It ends when all wanted components are known to `tolerance`, at the latest when v spans
the whole space; the number of scans is the number of steps.

Rows are scanned as blocks of small integers (8 to 64 bits a number, by block), written once to the shared folder.

Defined cases: null vectors and those with null or non-finite entries are left out, so are empty ones and those whose length
isn't the most frequent one (of equals the greater), as they have no place in the others' space; a component without deviation
has null for whitened and 0 for explained, and does not count in identity_error; repeated rows, null ids and ties of ids
are rows like others; an empty table gives no rows; extra columns are not read; entries whose scaled value is vectors.LARGEST
or more are an error, and so is a deviation beyond 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, stored
from sluice.llm.vectors import finite, scaled

#: Rows in a block.
_ROWS = 8192


def _blocks(rows: DataFrame, dims: int, factor: int) -> DataFrame:
    """(m, kind, data): the integers of m rows, in as few bits as they need."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                x = scaled(batch.column(1).slice(start, _ROWS), dims, factor)
                kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if -(1 << 8 * int(k[2]) - 1) <= x.min() and x.max() < 1 << 8 * int(k[2]) - 1)
                yield pa.RecordBatch.from_arrays([pa.array([len(x)], type=pa.int64()), pa.array([kind]), pa.array([x.astype(kind).tobytes()], type=pa.binary())], names=["m", "kind", "data"])

    return rows.mapInArrow(pack, "m long, kind string, data binary")


def _total(blocks: DataFrame, dims: int, of_rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of of_rows(integers). A task hands on one array of its own, however many rows it has read."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for m, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                one = of_rows(np.frombuffer(data, dtype=kind).reshape(m, dims))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([str(total.dtype)]), pa.array([total.tobytes()], type=pa.binary())], names=["kind", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = np.frombuffer(data, dtype=kind)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([str(total.dtype)]), pa.array([total.tobytes()], type=pa.binary())], names=["kind", "data"])

    schema = "kind string, data binary"
    (one,) = blocks.mapInArrow(each, schema).repartition(1).mapInArrow(add, schema).collect()
    return np.frombuffer(one.data, dtype=one.kind)


@dataclass
class Whitening:
    """What the fit has found: n rows with sums of their integers, components (a column each) by falling eigenvalue of the covariance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    steps: int

    def mean(self) -> np.ndarray:
        return np.array([int(s) / self.n for s in self.sums])

    def known(self) -> np.ndarray:
        """Which components have a deviation that is more than rounding."""
        return self.eigenvalues > 1e-13 * max(self.trace, 1e-300)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of integer rows; 0 for components without deviation."""
        scale = np.where(self.known(), 1 / np.sqrt(np.where(self.known(), self.eigenvalues, 1)), 0)
        return (x - self.mean()) @ (self.components * scale)


def bidiagonalise(product: Callable[[np.ndarray], tuple[float, np.ndarray]], dims: int, wanted: int, tolerance: float = 1e-15, seed: int = 13) -> tuple[np.ndarray, np.ndarray, int]:
    """(squared singular values, right singular vectors, steps) of X, the first `wanted`. product: takes a, gives |X a|**2 and X'X a."""
    rnd = np.random.default_rng(seed)
    vs, qs, at = np.zeros((0, dims)), np.zeros((0, dims)), np.zeros((0, dims))
    alphas: list[float] = []
    betas: list[float] = []

    def fresh() -> np.ndarray:
        z = rnd.standard_normal(dims)
        for _ in range(3):
            z = z - vs.T @ (vs @ z)
        return z / np.linalg.norm(z)

    v, most = fresh(), 0.0
    while True:
        a = v
        for _ in range(2):
            a = a - at.T @ (qs @ a)
        squared, q = product(a)
        alpha = float(np.sqrt(squared))
        most = max(most, alpha, *betas[-1:])
        full = alpha > 1e-14 * most
        alphas.append(alpha if full else 0.0)
        vs = np.vstack([vs, v])
        at = np.vstack([at, a / alpha if full else np.zeros(dims)])
        qs = np.vstack([qs, q / alpha if full else np.zeros(dims)])
        z = qs[-1] - alphas[-1] * v
        for _ in range(2):
            z = z - vs.T @ (vs @ z)
        beta = float(np.linalg.norm(z))
        beta = beta if beta > 1e-14 * most else 0.0
        k = len(alphas)
        left, sigma, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1) if betas else np.array([alphas]))
        found = k >= wanted and beta > 0 and bool(np.all(beta * np.abs(left[-1, :wanted]) <= tolerance * sigma[0]))
        if k == dims or found:
            return (sigma**2)[:wanted], (vs.T @ right.T)[:, :wanted], k
        betas.append(beta)
        v = z / beta if beta else fresh()


def fit(blocks: DataFrame, dims: int, components: int = 32) -> Whitening | None:
    """None without rows."""
    if not blocks.take(1):
        return None
    first = _total(blocks, dims, lambda x: np.r_[len(x), x.sum(axis=0, dtype=np.int64)])
    n, sums = int(first[0]), first[1:]
    mean = np.array([int(s) / n for s in sums])
    trace = float(_total(blocks, dims, lambda x: np.array([((x - mean) ** 2).sum()]))[0]) / n

    def product(a: np.ndarray) -> tuple[float, np.ndarray]:
        def rows(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            u = centred @ a  # X a
            return np.r_[u @ u, centred.T @ u]  # |u|**2 and X'u

        both = _total(blocks, dims, rows)
        return float(both[0]), both[1:]

    squares, axes, steps = bidiagonalise(product, dims, min(components, dims))
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    out = Whitening(n, sums, axes, squares / n, trace, 0.0, steps)
    has = out.known()

    def moments(x: np.ndarray) -> np.ndarray:
        w = out.whiten(x)[:, has]
        return np.r_[w.sum(axis=0), (w.T @ w).ravel()]

    if has.any():
        total = _total(blocks, dims, moments) / n
        p = int(has.sum())
        cov = total[p:].reshape(p, p) - np.outer(total[:p], total[:p])
        out.identity_error = float(np.abs(cov - np.eye(p)).max())
    return out


def whitened(df: DataFrame, components: int = 32, factor: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row per vector and component: (id_col, component, n, deviation, whitened, explained, identity_error)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where(finite(F.col("v")) & (F.size("v") > 0))
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("d", F.struct("n", "d")).alias("d"))
    dims = sizes.first().d
    if dims is None:
        return df.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("v") == dims)
    blocks = stored(_blocks(rows, dims, factor), "vector-blocks")
    w = fit(blocks, dims, components)
    discard(blocks)
    p, mean, known = min(components, dims), w.mean(), w.known()
    explained = np.where(known, w.eigenvalues / (w.trace or 1.0), 0.0)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                b = batch.slice(start, 1024)
                x = scaled(b.column(1), dims, factor)
                m = len(x)
                rough = ((w.n * (x - mean)) ** 2).sum(axis=1).max()
                gap = x * w.n - w.sums if rough < 1 << 62 else x.astype(object) * w.n - w.sums.astype(object)
                deviation = pa.array((gap * gap).sum(axis=1).tolist(), type=pa.int64())
                white = w.whiten(x)
                white[:, ~known] = np.nan
                again = pa.array(np.repeat(np.arange(m), p))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(again), pa.array(np.tile(np.arange(1, p + 1, dtype=np.int32), m)), pa.array(np.full(m * p, w.n)), deviation.take(again),
                        pa.array(white.ravel(), from_pandas=True), pa.array(np.tile(explained, m)), pa.array(np.full(m * p, w.identity_error)),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(give, schema)
