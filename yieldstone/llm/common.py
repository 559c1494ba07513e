"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole_text(df: DataFrame, column: str = "text") -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(df[column], F.lit(""))


#: Rows that go to Python at once where whole texts do, so that long ones don't add up.
BATCH_ROWS = 1000


def in_small_batches(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions of a DataFrame that run all their jobs themselves: batches for Python are small meanwhile."""

    @wraps(run)
    def wrapped(docs: DataFrame, *args, **options) -> DataFrame:
        conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = conf.get(key)
        conf.set(key, str(BATCH_ROWS))
        try:
            return run(docs, *args, **options)
        finally:
            conf.set(key, before)

    return wrapped


#: Bytes of a column that a task turns into Python objects at once.
SLICE_BYTES, SLICE_ROWS = 4_000_000, 1000


def sized_slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of rows whose sizes add up to about ``SLICE_BYTES``, one row at least."""
    sums, low = np.cumsum(sizes, dtype=np.int64), 0
    while low < batch.num_rows:
        before = sums[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sums, before + SLICE_BYTES, "right")))
        high = min(high, low + SLICE_ROWS)
        yield batch.slice(low, high - low)
        low = high


def byte_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches by the bytes of a binary or string column."""
    for batch in batches:
        yield from sized_slices(batch, pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))


def give_back() -> None:
    """Freed memory of this process back to the system: a worker is used again and would keep the most that any task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries have none
    if trim is not None:
        trim(0)


def frugal(run: Callable) -> Callable:
    """For task functions of batches: freed memory is given back after each batch and at the end."""

    def one_by_one(batches: Iterator) -> Iterator:
        for batch in batches:
            yield batch
            del batch
            give_back()

    @wraps(run)
    def wrapped(batches):
        yield from run(one_by_one(batches))
        give_back()

    return wrapped


def frugal_group(run: Callable) -> Callable:
    """The same for task functions of one group."""

    @wraps(run)
    def wrapped(group):
        out = run(group)
        del group
        give_back()
        return out

    return wrapped


class Scratch:
    """Tables written once under the shared folder, so that a lost executor costs no recomputation.

    ``result`` stores an operator's result and removes the tables that went into it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self.paths: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.mode("overwrite").parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        before, self.paths = self.paths, []
        stored = self.keep(df, "result")
        for path in before:
            drop_path(self.spark, path)
        return stored

    def drop(self) -> None:
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths = []
