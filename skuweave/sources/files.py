"""Spreadsheets, address results, board pages and object listings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skuweave.operators.cleaning import UNNAMED

# File name pattern of the address results.
ADDRESS_RESULT_FILES = "Kunden_result*.txt"

BOARD_PAGE = (
    "data struct<boards: array<struct<items: array<struct<"
    "name: string, column_values: array<struct<title: string, text: string>>>>>>>"
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """An exported worksheet with a header row, all columns as text.

    Spark calls a column without a header ``_c<n>``; it is named as unnamed here
    so that the sheet cleaning finds it.
    """
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    names = [
        f"{UNNAMED}: {i}" if re.fullmatch(f"_c{i}", name) else name
        for i, name in enumerate(df.columns)
    ]
    return df.toDF(*names)


def address_result_columns(owner: str, vendor: str) -> list[str]:
    """Names of the 12 columns of an address result, given who sends and who answers."""
    # What follows the two prefixes, in file order.
    owner_parts = ("id", "adr_id")
    vendor_parts = (
        "id", "name_1", "name_2", "strasse_1", "plz", "ort", "gt", "tel", "email",
    )
    return [f"{owner}_{p}" for p in owner_parts] + [f"{vendor}_{p}" for p in vendor_parts] + ["expdate"]


def read_address_results(
    spark: SparkSession, folder: str, columns: list[str], pattern: str = ADDRESS_RESULT_FILES
) -> DataFrame:
    """The tab-separated result files of a folder as one frame of text columns.

    Files may repeat the header row; ``drop_header_rows`` removes it.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("pathGlobFilter", pattern)
        .csv(folder)
    )


def read_board_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed board pages, one JSON document per file, with the file as page."""
    pages = spark.read.schema(BOARD_PAGE).option("multiLine", True).json(path)
    return pages.select(F.col("_metadata.file_path").alias("page"), "data")


def list_objects(spark: SparkSession, folder: str, pattern: str = "*.png") -> DataFrame:
    """``path`` and ``modificationTime`` of the objects below a folder; contents stay unread."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime")
    )
