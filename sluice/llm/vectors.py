"""Helpers of the vector operators: which vectors count, and integers from their entries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scaled entries must stay below this, so that sums of squared differences are exact in 64 bits.
LARGEST = 1 << 27


def finite(vec: Column) -> Column:
    """Whether a vector is there and has no null, NaN or infinite entry."""
    return vec.isNotNull() & F.forall(vec, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))


def scaled(vecs: pa.ListArray, dims: int, factor: int) -> np.ndarray:
    """floor(factor * entry) of vectors of dims entries each, as a matrix of 64-bit integers. Entries of LARGEST or more are an
    error: their squared distances would not fit."""
    x = np.floor(vecs.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * factor)
    if x.size and np.abs(x).max() >= LARGEST:
        raise ValueError(f"an entry times {factor} is {LARGEST} or more")
    return x.astype(np.int64).reshape(len(vecs), dims)
