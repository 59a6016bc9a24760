"""Cleaning of spreadsheet and text feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skuweave.functions.json_values import quoted
from skuweave.operators.columns import drop_columns_like

# Fixed value: how a column without a header is called.
UNNAMED = "Unnamed"


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def clean_sheet(df: DataFrame) -> DataFrame:
    """Drop the columns without a header, then the rows without any value."""
    return drop_empty_rows(drop_columns_like(df, UNNAMED))


def drop_header_rows(df: DataFrame, column: str, header: str | None = None) -> DataFrame:
    """Drop rows that repeat the header; rows with no value in the column stay.

    The header text defaults to the upper-case column name.
    """
    text = column.upper() if header is None else header
    return df.where(~F.col(quoted(column)).eqNullSafe(F.lit(text)))


def picture_uploads(listing: DataFrame, path: str = "path", stamp: str = "modificationTime") -> DataFrame:
    """``(sku, uploaded_at)`` of the pictures named by digits; the last path wins.

    The sku is the text ahead of the first ``.png`` of the file name.
    """
    name = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    return (
        listing.where(name.rlike(r"^[0-9]+\.png(.*\.png)?$"))
        .groupBy(F.regexp_extract(name, r"^([0-9]+)\.png", 1).alias("sku"))
        .agg(F.max_by(F.col(stamp), F.struct(path, stamp)).alias("uploaded_at"))
    )
