"""Columns generated from merchant keys found in the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skuweave.functions.json_values import quoted

# Keys that are not merchants.
EXCLUDED_FROM_COLUMNS = ("trinkkontor", "trinkkontor_trr", "merchant_key")
EXCLUDED_FROM_COUNT = ("trinkkontor", "trinkkontor_trr")


def union_keys(first: DataFrame, second: DataFrame, key: str = "merchant_key") -> DataFrame:
    return first.select(key).union(second.select(key)).distinct()


def without_keys(df: DataFrame, key: str, excluded: Sequence[str]) -> DataFrame:
    """Leave out the literal keys; a null key is not equal to any and stays."""
    for value in excluded:
        df = df.where(~F.col(key).eqNullSafe(F.lit(value)))
    return df


def sorted_keys(keys: DataFrame, key: str = "merchant_key", limit: int | None = None) -> list[str]:
    """The distinct non-null keys in ascending order, for building columns.

    Each key becomes columns of the result, so they are as few as a table's columns.
    More than a ``limit`` that the caller sets raise an error instead of being dropped.
    """
    found = keys.where(F.col(key).isNotNull()).select(key).distinct()
    rows = (found if limit is None else found.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"more than {limit} keys cannot become columns")
    return sorted(row[0] for row in rows)


def merchant_document_keys(keys: Sequence[str]) -> list[str]:
    """The document keys behind the three columns of each merchant."""
    return [
        name
        for key in keys
        for name in (f"gfgh_{key}_enabled", f"gfgh_{key}_id", f"freigabe_{key}_id")
    ]


def merchant_columns(values: str, keys: Sequence[str]) -> list[Column]:
    """``<m>_enabled`` (absent means false), ``<m>_id`` and ``<m>_freigabe``.

    ``values`` names a struct column with the fields of
    :func:`merchant_document_keys`. Keys are looked up exactly, so merchant ``a``
    never reads the value of merchant ``a_id_2``, and missing stays null.
    """

    def value(name: str) -> Column:
        return F.col(f"{quoted(values)}.{quoted(name)}")

    columns = []
    for key in keys:
        on = F.coalesce(F.lower(value(f"gfgh_{key}_enabled")) == "true", F.lit(False))
        columns += [
            on.alias(f"{key}_enabled"),
            value(f"gfgh_{key}_id").alias(f"{key}_id"),
            value(f"freigabe_{key}_id").alias(f"{key}_freigabe"),
        ]
    return columns


def count_true(flags: Sequence[str], offset: int = 0) -> Column:
    """How many of the boolean columns are true, plus ``offset``.

    An array is counted rather than a chain of additions, which for hundreds of
    merchants would be an expression hundreds of levels deep.
    """
    if not flags:
        return F.lit(offset).cast("int")
    marks = F.array(*[F.coalesce(F.col(quoted(f)), F.lit(False)) for f in flags])
    return (F.size(F.array_remove(marks, False)) + F.lit(offset)).cast("int")


def population_change(
    keys: DataFrame,
    state: DataFrame,
    key: str = "merchant_key",
    excluded: Sequence[str] = EXCLUDED_FROM_COUNT,
    state_column: str = "merchant_count",
) -> DataFrame:
    """One row: the current number of keys and whether it differs from the stored one."""
    current = without_keys(keys.select(key).distinct(), key, excluded).agg(
        F.count(F.lit(1)).alias("_current"), F.lit(None).cast("long").alias("_stored")
    )
    stored = state.agg(
        F.lit(None).cast("long").alias("_current"), F.max(state_column).cast("long").alias("_stored")
    )
    both = current.unionByName(stored).agg(
        F.max("_current").alias("merchant_count"), F.max("_stored").alias("_stored")
    )
    return both.select(
        "merchant_count", (~F.col("merchant_count").eqNullSafe(F.col("_stored"))).alias("changed")
    )
