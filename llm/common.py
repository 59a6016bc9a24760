"""Helpers that several operators share: columns as bytes, folds, size checks, tables."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast only when it was counted and has at most this many
# keys of eight bytes; beyond that the same join is left to a shuffle.
BROADCAST_KEYS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Python workers are told where this package is."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parent.parent)
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: str | Column) -> Column:
    """Text as its UTF-8 bytes, null as no bytes."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("binary"), F.lit(b"").cast("binary"))


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; -1 for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(-1))


def with_small(keys: DataFrame, count: int) -> DataFrame:
    """Mark counted keys for a broadcast where their number allows it."""
    return F.broadcast(keys) if count <= BROADCAST_KEYS else keys


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: 0


def freed(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A partition's function; at its end what it held goes back to the system.

    Python workers stay for later tasks, and what their allocators keep would count
    against the executors all that time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        _trim()(0)

    return run


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """One Arrow batch in, one out, on every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from slices(batch, function)

    return df.mapInArrow(freed(run), schema)


def slices(batch: pa.RecordBatch, function: Callable, most: int = 2_000_000) -> Iterator:
    """Apply to runs of rows of about ``most`` bytes, so that memory stays bounded."""
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, rows):
        yield function(batch.slice(start, rows))


def word_codes(texts: list[bytes], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Number the words of all texts; new words extend ``known``.

    Returns the numbers of all texts in a row and each text's number of words. Words
    are runs of bytes other than the six ASCII white-space characters, which is what
    ``bytes.split`` takes.
    """
    every: list[int] = []
    lengths = np.zeros(len(texts), np.int64)
    add = known.setdefault
    for at, text in enumerate(texts):
        words = text.split()
        lengths[at] = len(words)
        every.extend([add(word, len(known)) for word in words])
    return np.array(every, np.int64), lengths


def mix(values: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every bit of the input reaches every bit of the output."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(hashes: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words that lie within one text.

    ``hashes`` holds one 64-bit hash per word for all texts in a row. Returns the
    windows' hashes, text after text, and each text's number of windows.
    """
    counts = np.maximum(lengths - size + 1, 0)
    total = len(hashes) - size + 1
    if total <= 0 or not counts.any():
        return np.zeros(0, np.uint64), np.zeros(len(lengths), np.int64)
    rolled = np.full(total, size, np.uint64)
    for step in range(size):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[step : step + total]
    ends = np.cumsum(lengths)
    inside = np.zeros(len(hashes) + 1, np.int32)
    begins = (ends - lengths)[counts > 0]
    np.add.at(inside, begins, 1)
    np.add.at(inside, begins + counts[counts > 0], -1)
    return mix(rolled[np.cumsum(inside[:-1])[:total] > 0]), counts


def code_points(text: bytes) -> int:
    """Characters of a UTF-8 text."""
    return len(text.decode("utf-8", "replace"))
