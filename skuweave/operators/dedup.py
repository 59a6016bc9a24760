"""One row per key, and the maximum per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def sortable_columns(df: DataFrame) -> list[str]:
    unsortable = (T.MapType, T.VariantType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, unsortable)]


def keep_one(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """Keep the first row of each key in ``order``, then in the remaining columns.

    The remaining columns break ties, so the kept row does not depend on how the
    input is partitioned. Spark keeps one row per key and task before the shuffle
    (window group limit), so a key holding most of the rows stays cheap.
    """
    named = {c for c in order if isinstance(c, str)} | set(keys)
    rest = [F.col(f"`{c}`") for c in sortable_columns(df) if c not in named]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_kept", F.row_number().over(window)).where("_kept = 1").drop("_kept")


def max_per_key(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The maximum of each column per key; rows without a key are left out."""
    columns = [c for c in (columns or df.columns) if c != key]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.max(c).alias(c) for c in columns])
    )


def attach_max_per_key(
    df: DataFrame, details: DataFrame, df_key: str, key: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Left join to one aggregated row per key."""
    best = max_per_key(details, key, columns)
    return df.join(best, F.col(df_key) == best[key], "left")
