"""Small helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one round of array work in a task takes at a time (a longer text comes alone).
ROUND_BYTES = 2_000_000


def need(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns only, so that clashing or extra columns of a caller never matter."""
    return df.select(*(F.col(f"`{c}`") for c in columns))


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_rounds(column: pa.Array, most: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of an Arrow text column, ``most`` bytes at a time.

    A null text counts as empty.
    """
    most = ROUND_BYTES if most is None else most
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    _, where, data = column.buffers()
    ends = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(ends, ends[first] + most, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, held[ends[first] : ends[end]], ends[first : end + 1] - ends[first]
        first = end


def keep_freed_arrays() -> None:
    """Let this process reuse the memory of freed arrays.

    The C library hands larger arrays back to the system, and every new one is zeroed again page by page,
    until one has been freed that was larger still (32 MB at most).  This one is, and no page of it is touched.
    """
    np.empty(30_000_000, np.uint8)


def buckets_for(df: DataFrame, column: str, bytes_each: int, least: int = 8) -> int:
    """How many buckets hold about ``bytes_each`` bytes of a text column; one cheap pass."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(least, math.ceil(total / bytes_each))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of unsigned 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)
