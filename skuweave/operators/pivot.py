"""Items with a list of titled texts as one column per title."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def explode_items(pages: DataFrame) -> DataFrame:
    """Items of landed board pages, with the page and position as item id.

    The feed has no item id, and names repeat; page and position identify an item.
    """
    return pages.select(
        F.col("page"), F.posexplode(F.col("data.boards")[0]["items"]).alias("position", "item")
    ).select(
        "page", "position", F.col("item.name").alias("name"),
        F.col("item.column_values").alias("column_values"),
    )


def titles_of(items: DataFrame, column: str = "column_values", limit: int | None = None) -> list[str]:
    """The distinct titles over all items, sorted. Each becomes a column.

    More than a ``limit`` that the caller sets raise an error.
    """
    found = (
        items.select(F.explode(column).alias("v")).select("v.title").where("title is not null").distinct()
    )
    rows = (found if limit is None else found.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"more than {limit} titles cannot become columns")
    return sorted(row[0] for row in rows)


def pivot_items(
    items: DataFrame, titles: Sequence[str], keep: Sequence[str] = ("name",), column: str = "column_values"
) -> DataFrame:
    """One column per title, read from the item's own list.

    The list is already within the row, so nothing is grouped or shuffled. Where
    a title repeats within an item its first text is taken.
    """

    def text(title: str) -> Column:
        found = F.filter(F.col(column), lambda v: v["title"] == F.lit(title))
        return F.get(found, F.lit(0))["text"].alias(title)

    return items.select(*keep, *[text(t) for t in titles])


def pivot_rows(
    df: DataFrame, key: Sequence[str], title: str, text: str, titles: Sequence[str], order: str
) -> DataFrame:
    """One column per title for rows that hold one titled text each.

    The first text in ``order`` is taken. The minimum is kept per task before the
    shuffle, so an item with very many rows is not gathered anywhere.
    """
    return df.groupBy(*key).agg(
        *[
            F.min_by(F.col(text), F.when(F.col(title) == t, F.struct(order, text))).alias(t)
            for t in titles
        ]
    )
