"""Day arithmetic relative to an explicit ``as_of`` day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

AsOf = dt.date | str | None


def day(as_of: AsOf) -> Column:
    """The day as a date column; ``None`` means the day the job runs."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def shifted(as_of: AsOf, days: int) -> Column:
    return F.date_add(day(as_of), days)


def week_start(as_of: AsOf, days: int) -> Column:
    """``days`` days before the Saturday that precedes the week of ``as_of``.

    ``dayofweek`` counts Sunday as 1, so subtracting it lands on a Saturday.
    """
    return F.date_sub(day(as_of), F.dayofweek(day(as_of)) + F.lit(days))


def bound(df: DataFrame, column: str, value: Column) -> Column:
    """Cast a constant day to the type of ``column``.

    The cast stays on the constant side, so Spark folds it to a literal and the
    comparison reaches the scan (Parquet row groups, JDBC ``WHERE``).
    """
    return value.cast(df.schema[column].dataType)


def epoch_millis(column: Column) -> Column:
    """Milliseconds since 1970 of midnight UTC of the value's day; null stays null."""
    days = F.unix_date(column.cast("date")).cast("long")
    return days * F.lit(86_400_000).cast("long")
