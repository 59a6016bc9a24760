"""Copying tables: whole, by key, appended, or the recent slice."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from skuweave.functions.dates import AsOf
from skuweave.operators.merge import append, stamped, upsert
from skuweave.operators.scans import date_window, look_back
from skuweave.session import cut_lineage
from skuweave.sinks.tables import (
    append_table,
    replace_table,
    table_folder,
    upsert_partitions,
    with_json_text,
)

FULL_RELOAD = "FULL_RELOAD"
UPSERT = "UPSERT"
INSERT_NEW_ROWS = "INSERT_NEW_ROWS"
INSERT_NEW_ROWS_DROP_OLD_TABLE = "INSERT_NEW_ROWS_DROP_OLD_TABLE"
MODES = (FULL_RELOAD, UPSERT, INSERT_NEW_ROWS, INSERT_NEW_ROWS_DROP_OLD_TABLE)


@dataclass(frozen=True)
class Sync:
    mode: str
    key: str = "id"
    stamp: str = "updated_at"
    look_back_days: int = 0
    days_back: int = 2
    days_ahead: int = 1
    # A column that partitions the target: an upsert then rewrites only what it touches.
    partition_by: str | None = None

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"unknown mode {self.mode!r}, expected one of {', '.join(MODES)}")


def batch_of(source: DataFrame, sync: Sync, as_of: AsOf) -> DataFrame:
    """The rows of the source that the mode copies."""
    if sync.mode == FULL_RELOAD:
        return source
    if sync.mode == INSERT_NEW_ROWS_DROP_OLD_TABLE:
        return look_back(source, sync.stamp, as_of, sync.look_back_days)
    return date_window(source, sync.stamp, as_of, sync.days_back, sync.days_ahead)


def sync_table(
    source: DataFrame,
    target: DataFrame | None,
    sync: Sync,
    as_of: AsOf = None,
    stamp_with: Column | None = None,
) -> DataFrame:
    """The target after the copy; rows copied now carry the audit time.

    The first upsert has no target to merge into and copies the whole source, since a
    table of the last days alone would look complete.
    """
    if target is None and sync.mode == UPSERT:
        return stamped(source, stamp_with)
    batch = stamped(batch_of(source, sync, as_of), stamp_with)
    if target is None or sync.mode in (FULL_RELOAD, INSERT_NEW_ROWS_DROP_OLD_TABLE):
        return batch
    if sync.mode == UPSERT:
        return upsert(target, batch, sync.key)
    return append(target, batch)


def run_sync(
    source: DataFrame, table: str, root: str, sync: Sync, as_of: AsOf = None, json_text: bool = True
) -> None:
    """Copy into a catalog table whose versions are kept below ``root``."""
    spark = source.sparkSession
    parts = [sync.partition_by] if sync.partition_by else []
    if json_text:
        source = with_json_text(source)
    target = spark.table(table) if spark.catalog.tableExists(table) else None
    if target is not None and sync.mode == INSERT_NEW_ROWS:
        append_table(stamped(batch_of(source, sync, as_of)), table)
    elif target is not None and sync.mode == UPSERT:
        # A merge uses the batch twice. It is read once, so that rows changing in the
        # source meanwhile cannot be deleted without being inserted.
        batch = cut_lineage(stamped(batch_of(source, sync, as_of)))
        if sync.partition_by and set(batch.columns) <= set(target.columns):
            upsert_partitions(batch, table_folder(spark, table), sync.key, sync.partition_by)
            spark.catalog.recoverPartitions(table)
            spark.catalog.refreshTable(table)
        else:
            replace_table(upsert(target, batch, sync.key), table, root, parts)
    else:
        replace_table(sync_table(source, target, sync, as_of), table, root, parts)
