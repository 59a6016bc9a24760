"""Bounded cells in which the rows of two sides that share a key meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skuweave.session import cut_lineage

# Rows of one side a cell is meant to hold, and up to how many split keys their list
# is broadcast; beyond that it is joined by a shuffle. Cells never grow with the data.
CELL_ROWS = 2_048
BROADCAST_KEYS = 1_000_000

PLACE = ("cell", "q_slot", "c_slot")


def meet(
    queries: DataFrame,
    catalog: DataFrame,
    key: str,
    totals: tuple[int, int] | None = None,
    cell_rows: int = CELL_ROWS,
    broadcast_keys: int = BROADCAST_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """Place ``(id, key)`` rows of both sides so that equal keys always meet.

    Rare keys share a cell. A key beyond the size of a cell is split: its rows are
    spread over slots per side, and every query slot meets every catalogue slot, so
    no task holds a hot key. Both results keep their columns and gain ``cell``,
    ``q_slot`` and ``c_slot``. Different keys may meet as well.
    """
    totals = totals or (queries.count(), catalog.count())
    bundles = max(1, *(-(-total // cell_rows) for total in totals))

    def split(side: DataFrame, name: str) -> DataFrame:
        return (
            side.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cell_rows)
            .select(key, F.ceil(F.col("_n") / F.lit(cell_rows)).cast("int").alias(name))
        )

    # At most total / cell_rows keys exceed a cell, on either side.
    slots = (
        split(queries, "_q_slots")
        .unionByName(split(catalog, "_c_slots"), allowMissingColumns=True)
        .groupBy(key)
        .agg(F.max("_q_slots").alias("_q_slots"), F.max("_c_slots").alias("_c_slots"))
        .select(
            key,
            F.coalesce("_q_slots", F.lit(1)).alias("_q_slots"),
            F.coalesce("_c_slots", F.lit(1)).alias("_c_slots"),
        )
    )
    slots = cut_lineage(slots)
    if slots.count() <= broadcast_keys:
        slots = F.broadcast(slots)
    hashed = F.xxhash64(key)
    bundle = F.pmod(hashed, F.lit(bundles).cast("long"))
    own_cell = -F.pmod(hashed, F.lit(1 << 62)) - F.lit(1).cast("long")

    def place(side: DataFrame, own: str, other: str) -> DataFrame:
        def count(name: str) -> Column:
            return F.coalesce(F.col(f"_{name}s"), F.lit(1))

        return side.join(slots, key, "left").select(
            *side.columns,
            F.when(F.col("_q_slots").isNull(), bundle).otherwise(own_cell).alias("cell"),
            F.pmod(F.xxhash64("id"), count(own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), count(other) - F.lit(1))).alias(other),
        )

    return place(queries, "q_slot", "c_slot"), place(catalog, "c_slot", "q_slot")
