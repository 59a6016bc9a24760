"""Column lists: renaming, dropping, ordering, joining without collisions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from skuweave.functions.json_values import quoted


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns that exist."""
    return df.drop(*names)


def drop_columns_like(df: DataFrame, pattern: str) -> DataFrame:
    """Drop the columns whose name begins with the pattern, in any case."""
    expression = re.compile(pattern, re.IGNORECASE)
    return df.select(*[F.col(quoted(c)) for c in df.columns if not expression.match(c)])


def columns_first(df: DataFrame, names: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in names]
    return df.select(*[F.col(quoted(c)) for c in [*names, *rest]])


def restrict_and_enrich(df: DataFrame, facts: DataFrame, df_key: str, facts_key: str) -> DataFrame:
    """Inner join that adds the columns of ``facts`` which ``df`` does not have.

    Overlapping columns of ``facts`` are left out before the join, so nothing is
    suffixed and no column of ``df`` can be lost.
    """
    taken = {c.lower() for c in df.columns}
    added = [c for c in facts.columns if c.lower() not in taken]
    slim = facts.select(
        F.col(quoted(facts_key)).alias("_facts_key"), *[F.col(quoted(c)) for c in added]
    )
    return df.join(slim, F.col(quoted(df_key)) == F.col("_facts_key"), "inner").drop("_facts_key")
