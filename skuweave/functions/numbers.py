"""Numbers out of text, and what does not parse."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def number(column: Column, kind: str) -> Column:
    """``column`` as a number, null where the text is none, whatever the ANSI setting."""
    return column.try_cast(kind)


def unparsed(
    df: DataFrame,
    key: str,
    kinds: Mapping[str, str],
    side: str,
    reading: Callable[[str], Column] = F.col,
) -> DataFrame:
    """``(side, key, column, text, reason)``: one row per text that is not a number of its kind.

    ``reading`` gives the form in which a column is parsed. Null is missing, not wrong.
    """
    wrong = [
        F.when(
            reading(name).isNotNull() & number(reading(name), kind).isNull(),
            F.struct(
                F.lit(name).alias("column"),
                F.col(name).cast("string").alias("text"),
                F.lit(f"not a number of kind {kind}").alias("reason"),
            ),
        )
        for name, kind in kinds.items()
    ]
    found = df.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(F.array(*wrong))).alias("wrong"))
    return found.select(F.lit(side).alias("side"), "key", "wrong.*")


def refuse(rejects: DataFrame) -> None:
    """End the job if there are rejects, and say how many and which text comes first."""
    row = rejects.agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("text")).first()
    if row["n"]:
        raise ValueError(f"not a number: {row['text']} ({row['n']} in all)")
