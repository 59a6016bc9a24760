"""Database tables and queries over JDBC, and tables of the catalog or of Parquet."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Database:
    """Where a database is and how to log in; ``options`` go to the JDBC driver."""

    url: str
    options: dict[str, str] = field(default_factory=dict)


def table_options(
    database: Database,
    table: str,
    split_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_rows: int = FETCH_ROWS,
) -> dict[str, str]:
    """Options of a table read; with a split column the read runs in ranges.

    The bounds only place the ranges, rows outside them are still read.
    """
    options = {**database.options, "url": database.url, "dbtable": table, "fetchsize": str(fetch_rows)}
    if split_column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a split column needs lower, upper and partitions")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def query_options(database: Database, query: str, fetch_rows: int = FETCH_ROWS) -> dict[str, str]:
    return {**database.options, "url": database.url, "query": query, "fetchsize": str(fetch_rows)}


def read_table(spark: SparkSession, database: Database, table: str, **split) -> DataFrame:
    """A database table; filters and column choice that follow are pushed down."""
    return spark.read.format("jdbc").options(**table_options(database, table, **split)).load()


def read_query(spark: SparkSession, database: Database, query: str) -> DataFrame:
    """The result of a query the database runs; it arrives in one partition."""
    return spark.read.format("jdbc").options(**query_options(database, query)).load()


def read_stored(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A Parquet folder where the text has a slash, else a catalog table."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
