"""Staged tables and Arrow batches, shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources.storage import shared_dir

#: Text handled at once inside a task; bounds the memory of all per-batch arrays, one document aside.
BATCH_BYTES = 8 << 20


class Workspace:
    """Tables of one run, in a folder of their own below the shared one.

    A table that is written and read again survives lost executors, is computed once, and shows Spark its
    true size. Tables that later steps no longer need are dropped at once; what the returned DataFrame
    reads stays until `clear` is called.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        with shuffles_removed(self.spark):
            df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))

    def clear(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """While a table is staged, shuffle files go when the write ends: the table replaces them."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(column: pa.Array) -> pa.Array:
    """Null texts count as empty ones."""
    return pc.fill_null(column.cast(pa.string()), "")


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about `limit` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.string())), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
            # what the last slice took goes back to the system: other workers share the machine
            pa.default_memory_pool().release_unused()


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words between runs of ASCII white space (0x20, 0x09-0x0D): row offsets and the flat words.

    White space at either end of a text gives an empty word there.
    """
    lists = pc.ascii_split_whitespace(texts)
    return lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()


def encode_dictionary(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Index of each value among the distinct ones, and those."""
    coded = values.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def sums_by_row(offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each row."""
    total = np.concatenate([[0], np.cumsum(values, dtype=values.dtype if values.dtype.kind == "f" else np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
