"""The given tables, and helpers all operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from swipeline.session import tune

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PACKED = "__row"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns or ("*",))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of a row in one struct beside its text, so that an operator can carry
    rows along whatever their columns are called."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(PACKED),
                       F.col(f"`{text}`").alias("__text"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `limit` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(byte_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_lengths(column: pa.Array) -> np.ndarray:
    return np.diff(text_buffers(column)[0])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row offsets from 0, bytes) of a text column; a null row is empty."""
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def give_back() -> None:
    """Return memory that this process has freed to the system. Python workers live on from stage
    to stage, and what they keep without using counts against their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def map_rows(
    docs: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], added: str
) -> DataFrame:
    """Run a function over packed rows; it yields them with the added columns."""
    kind = docs.schema[PACKED].dataType.simpleString()
    return docs.mapInArrow(function, f"{PACKED} {kind}, {added}")
