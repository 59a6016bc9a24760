"""Loading the external feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from skuweave.operators.cleaning import clean_sheet, drop_header_rows, picture_uploads
from skuweave.operators.columns import lower_case_columns
from skuweave.operators.merge import stamped
from skuweave.operators.pivot import explode_items, pivot_items, titles_of
from skuweave.plans.store import store
from skuweave.sources.files import (
    list_objects,
    read_address_results,
    read_board_pages,
    read_sheet,
)


def sheet(spark: SparkSession, path: str) -> DataFrame:
    return clean_sheet(read_sheet(spark, path))


def board(spark: SparkSession, path: str, titles: Sequence[str] | None = None) -> DataFrame:
    """One row per item, one column per title of any item, and the load time."""
    items = explode_items(read_board_pages(spark, path))
    titles = titles_of(items) if titles is None else titles
    return stamped(pivot_items(items, titles))


def address_results(spark: SparkSession, folder: str, columns: Sequence[str], **options: str) -> DataFrame:
    """All result files with lower-case columns and without repeated headers."""
    named = lower_case_columns(read_address_results(spark, folder, list(columns), **options))
    return drop_header_rows(named, named.columns[0])


def pictures(spark: SparkSession, folder: str) -> DataFrame:
    return picture_uploads(list_objects(spark, folder))


def run_addresses(spark: SparkSession, folder: str, columns: Sequence[str], table: str, root: str, **options: str) -> int:
    """Replace the address table by all result files, with the load time; returns the rows."""
    return store(stamped(address_results(spark, folder, columns, **options)), table, root)


def run_pictures(spark: SparkSession, folder: str, table: str, root: str) -> int:
    """Replace the picture table by what is listed below ``folder``; returns the rows."""
    return store(pictures(spark, folder), table, root)
