"""What the two vector operators share: which vectors take part, and packing them as bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: str) -> Column:
    """Neither null nor empty nor zero, no null or non-finite component."""
    x = F.col(vec).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def by_length(batch, column: int):
    """(length, rows) for each length of vectors in an Arrow batch."""
    size = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    if len(size) and (size == size[0]).all():
        yield int(size[0]), batch
        return
    for length in np.unique(size).tolist():
        yield length, batch.filter(pa.array(size == length))


def matrix(column, length: int) -> np.ndarray:
    """An Arrow list column without nulls as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, length)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def pivots(df: DataFrame, key: str, vec: str, count: int, length: int) -> np.ndarray:
    """At most `count` distinct unit vectors of one length, chosen by a hash of the key."""
    own = df.where(F.size(vec) == length)
    got = own.select(F.col(vec).cast("array<double>").alias("v"), F.xxhash64(F.col(key)).alias("h"), F.col(key).alias("i")).orderBy("h", "i").limit(count).collect()
    if not got:
        return np.zeros((0, length))
    x = unit(np.array([r["v"] for r in got], dtype=np.float64))
    return x[np.sort(np.unique(x.round(6), axis=0, return_index=True)[1])]


def mixed(key: np.ndarray) -> np.ndarray:
    """31 well-mixed bits of whole numbers."""
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


def spans(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i repeated counts[i] times, 0..counts[i]-1 beside it)."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
