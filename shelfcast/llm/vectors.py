"""Vectors that take part in comparisons, and classes of equal ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import Workspace


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, one of them not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes(work: Workspace, rows: DataFrame, name: str) -> DataFrame:
    """Equal usable vectors as one row: vector, node (a unique number), copies, first_id.

    `rows` has columns id and vector. Copies are counted map-side, however many there are.
    """
    grouped = rows.where(usable(F.col("vector"))).groupBy("vector")
    found = grouped.agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"))
    return work.keep(found.withColumn("node", F.monotonically_increasing_id()), name)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def finite(vector: Column) -> Column:
    """Not null, and no component null or non-finite; empty and zero vectors pass."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def padded(column: pa.Array, size: int = 0) -> np.ndarray:
    """Vectors as rows in double precision, zeros after the end of shorter ones; at least `size` columns."""
    ends = column.offsets.to_numpy()
    lengths = np.diff(ends)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = max(size, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == size).all():
        return flat.reshape(len(lengths), size)
    rows = np.zeros((len(lengths), size))
    rows[np.arange(size)[None] < lengths[:, None]] = flat
    return rows


def whole_steps(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, exactly: int64, or Python integers where one would not fit.

    `scale` must be a power of two, so that the product is exact, or overflows to infinity and is taken apart.
    """
    with np.errstate(over="ignore"):
        scaled = np.floor(rows * scale)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    whole = [int(x) if abs(x) < 2.0**62 else int(y) * scale for x, y in zip(scaled.ravel(), rows.ravel())]
    return np.array(whole, dtype=object).reshape(rows.shape)


def largest(values: np.ndarray) -> int:
    """Largest absolute value, 0 of none."""
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0
