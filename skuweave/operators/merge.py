"""Replacing, appending and merging batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

UPDATED_AT = "_updated_at"


def stamped(df: DataFrame, at: Column | None = None, column: str = UPDATED_AT) -> DataFrame:
    """Add the audit column."""
    return df.withColumn(column, F.current_timestamp() if at is None else at)


def without_keys_of(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``target`` whose key is not in ``batch``. A null key is in no batch.

    The keys of the batch are not made distinct first: an anti-join does not need
    it, and AQE only splits a hot key where both sides come straight from a shuffle.
    """
    return target.join(batch.select(*keys), list(keys), "left_anti")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows of the batch replace those of the target with the same key.

    All rows of the batch are added, target keys the batch lacks survive, and
    an empty batch changes nothing. Columns only one side has are null on the other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return without_keys_of(target, batch, keys).unionByName(batch, allowMissingColumns=True)


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Add the batch; applying it again adds it again."""
    return target.unionByName(batch, allowMissingColumns=True)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
