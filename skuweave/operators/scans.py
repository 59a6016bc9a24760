"""Date-window predicates for incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skuweave.functions.dates import AsOf, bound, shifted, week_start


def date_window(
    df: DataFrame, column: str, as_of: AsOf, days_back: int = 2, days_ahead: int = 1
) -> DataFrame:
    """Rows of ``[as_of - days_back, as_of + days_ahead)``, whole days."""
    stamp = F.col(column)
    return df.where(
        (stamp >= bound(df, column, shifted(as_of, -days_back)))
        & (stamp < bound(df, column, shifted(as_of, days_ahead)))
    )


def look_back(df: DataFrame, column: str, as_of: AsOf, days: int) -> DataFrame:
    """Rows since ``days`` days before the Saturday ahead of the current week."""
    return df.where(F.col(column) >= bound(df, column, week_start(as_of, days)))


def closed_window(df: DataFrame, column: str, as_of: AsOf, days_back: int = 2) -> DataFrame:
    """Rows between midnight ``days_back`` days ago and midnight of ``as_of``, both in."""
    return df.where(
        F.col(column).between(
            bound(df, column, shifted(as_of, -days_back)),
            bound(df, column, shifted(as_of, 0)),
        )
    )


def _any_recent(df: DataFrame, columns: tuple[str, ...], as_of: AsOf, days: int):
    recent = F.lit(False)
    for column in columns:
        recent = recent | (F.col(column) >= bound(df, column, shifted(as_of, -days)))
    return recent


def changed_rows(
    rows: DataFrame,
    parents: DataFrame,
    row_parent: str,
    parent_key: str,
    row_stamps: tuple[str, ...] = ("updated", "created"),
    parent_stamps: tuple[str, ...] = ("updated", "created"),
    as_of: AsOf = None,
    days: int = 4,
) -> DataFrame:
    """Rows changed within ``days`` days themselves or through their parent.

    Two branches that no row is in both of. Rows recent by their own stamps are found
    by a filter that reaches their scan. Of the others only key columns are matched
    with the keys of recently changed parents, whose filter reaches their scan, too.
    A row whose parent is missing qualifies by its own stamps only; parents that
    repeat do not repeat rows, and rows that repeat stay so.
    """
    own = _any_recent(rows, row_stamps, as_of, days)
    changed = (
        parents.where(_any_recent(parents, parent_stamps, as_of, days))
        .select(F.col(parent_key).alias(row_parent))
        .where(F.col(row_parent).isNotNull())
        .distinct()
    )
    others = rows.where(~F.coalesce(own, F.lit(False)) & F.col(row_parent).isNotNull())
    return rows.where(own).unionByName(others.join(changed, row_parent, "left_semi"))
