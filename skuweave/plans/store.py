"""Storing the results of feeds, matches and product loads, with their row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skuweave.functions.dates import AsOf
from skuweave.operators.observe import counted
from skuweave.plans.products import (
    ProductSources,
    delta_rows,
    full_load,
    needs_full_load,
)
from skuweave.sinks.tables import BUCKET, bucket_of, replace_buckets, replace_table, replace_view, view_properties, view_version


def store(df: DataFrame, table: str, root: str) -> int:
    """Replace ``table`` by the frame; returns the number of rows, counted on the way."""
    rows, observation = counted(df)
    replace_table(rows, table, root)
    return observation.get["rows"]


def stored_state(spark: SparkSession, table: str) -> DataFrame:
    """The stored number of merchants, no row where nothing was stored yet."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], "merchant_count long")


def run_products(
    sources: ProductSources, table: str, state_table: str, root: str, as_of: AsOf = None, days: int = 4, buckets: int = 64
) -> str:
    """Bring the product table up to date; returns ``full`` or ``delta``.

    A changed number of merchants, or no table yet, calls for a full load, as new
    merchants are new columns. The number is stored after the table, so that a load
    that fails is repeated in full.

    ``table`` is a view over the current version, which is stored in ``buckets`` of the
    identifier. A full load writes a new version and redefines the view; a delta rewrites
    the buckets of the changed products and no others. The number of buckets is kept with
    the view, so a later one holds from the next full load on.
    """
    spark = sources.products.sparkSession
    state = needs_full_load(sources, stored_state(spark, state_table)).first()
    if state["changed"] or not spark.catalog.tableExists(table):
        rows = full_load(sources).withColumn(BUCKET, bucket_of(F.col("identifier"), buckets))
        # One task per bucket, so that a bucket is one file.
        replace_view(rows.repartition(buckets, BUCKET), table, root, [BUCKET], [BUCKET], buckets=str(buckets))
        current = spark.range(1).select(F.lit(state["merchant_count"]).cast("long").alias("merchant_count"))
        store(current, state_table, root)
        return "full"
    changed, rows = delta_rows(sources, as_of, days)
    stored = int(view_properties(spark, table)["buckets"])
    replace_buckets(spark, view_version(spark, table), changed, rows, "identifier", stored)
    spark.catalog.refreshTable(table)
    return "delta"
