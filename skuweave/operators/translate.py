"""Replace option codes by their values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from skuweave.functions.json_values import quoted
from skuweave.session import cut_lineage

# The translated columns of the product table, and how many times
# the lookup is applied. Two are translated twice because their values are codes.
PRODUCT_PASSES = {
    "net_content_liter": 1,
    "net_content_uom": 2,
    "type_single_unit": 1,
    "amount_single_unit": 2,
    "structure_packaging_unit": 1,
    "type_packaging_unit": 1,
    "golden_record_level1": 1,
    "status_base": 1,
    "brand": 1,
}

# A lookup is broadcast up to this many rows and characters.
BROADCAST_ROWS = 1_000_000
BROADCAST_CHARACTERS = 64_000_000


def option_values(options: DataFrame, values: DataFrame) -> DataFrame:
    """``(code, value)`` of every option; an option without a value has a null one."""
    return options.select("id", "code").join(
        values.select("option_id", "value"), F.col("id") == F.col("option_id"), "left"
    ).select("code", "value")


def unique_lookup(options: DataFrame) -> DataFrame:
    """One value per code. Several values would multiply the translated rows."""
    return (
        options.where(F.col("code").isNotNull())
        .groupBy("code")
        .agg(F.min("value").alias("value"))
        .where(F.col("value").isNotNull())
    )


def chained(lookup: DataFrame, passes: int) -> DataFrame:
    """The lookup applied ``passes`` times: a value that is itself a code is followed."""
    result = lookup
    for _ in range(passes - 1):
        step = lookup.select(F.col("code").alias("_code"), F.col("value").alias("_next"))
        result = (
            result.join(step, F.col("value") == F.col("_code"), "left")
            .select("code", F.coalesce("_next", "value").alias("value"))
        )
    return result


def fits_broadcast(
    lookup: DataFrame, rows: int = BROADCAST_ROWS, characters: int = BROADCAST_CHARACTERS
) -> bool:
    size = lookup.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.length("code") + F.length("value")), F.lit(0)).alias("c"),
    ).first()
    return size["n"] <= rows and size["c"] <= characters


def translate_codes(
    df: DataFrame,
    lookup: DataFrame,
    passes: Mapping[str, int],
    broadcast: bool | None = None,
    rows: int = BROADCAST_ROWS,
    characters: int = BROADCAST_CHARACTERS,
) -> DataFrame:
    """Replace each listed column by its value in ``lookup``, else keep the code.

    ``lookup`` has one row per code (:func:`unique_lookup`). While its measured
    size allows it is broadcast and no row of ``df`` moves. Beyond that bound the
    codes are translated in long form, with the same result: one narrow join for all
    columns instead of one shuffle of the wide rows each. ``broadcast`` skips the
    measurement.
    """
    if broadcast is None:
        broadcast = fits_broadcast(lookup, rows, characters)
    if not broadcast:
        return _translate_long(df, lookup, passes)
    kept = df.columns
    chains = {n: chained(lookup, n) for n in set(passes.values())}
    for position, (column, n) in enumerate(passes.items()):
        code, value = f"_code_{position}", f"_value_{position}"
        step = chains[n].select(F.col("code").alias(code), F.col("value").alias(value))
        df = df.join(F.broadcast(step), F.col(quoted(column)) == F.col(code), "left")
    value_of = {column: f"_value_{i}" for i, column in enumerate(passes)}
    return df.select(
        *[
            F.coalesce(F.col(value_of[c]), F.col(quoted(c))).alias(c) if c in value_of else F.col(quoted(c))
            for c in kept
        ]
    )


def _translate_long(df: DataFrame, lookup: DataFrame, passes: Mapping[str, int]) -> DataFrame:
    """Codes as ``(row, column, code)`` rows, joined per number of passes.

    Rows are numbered and written first, so that their numbers are unique and do not
    change when a task is repeated, whatever keys the rows have or repeat.

    Absent codes are left out before the shuffle, so they form no hot key; a hot
    code is on the splittable side of the left join.
    """
    kept = df.columns
    df = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    cells = df.select(
        "_row",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.lit(n).alias("passes"), F.col(quoted(c)).alias("code"))
                    for c, n in passes.items()
                ]
            )
        ).alias("_cell"),
    ).select("_row", "_cell.*").where("code is not null")
    found = None
    for n in sorted(set(passes.values())):
        part = cells.where(F.col("passes") == n).join(chained(lookup, n), "code").select("_row", "column", "value")
        found = part if found is None else found.unionByName(part)
    wide = found.groupBy("_row").agg(
        *[
            F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_value_{i}")
            for i, c in enumerate(passes)
        ]
    )
    value_of = {column: f"_value_{i}" for i, column in enumerate(passes)}
    return df.join(wide, "_row", "left").select(
        *[
            F.coalesce(F.col(value_of[c]), F.col(quoted(c))).alias(c) if c in value_of else F.col(quoted(c))
            for c in kept
        ]
    )
