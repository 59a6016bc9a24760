"""Attributes of products, resolved through model and parent model."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from skuweave.functions.json_values import attribute_value, parse_attributes, without_quotes


@dataclass(frozen=True)
class Attribute:
    """An output column, the document key it is read from and which level wins."""

    name: str
    key: str
    product_first: bool = False


def attributes(
    model_first: Iterable[str] = (),
    product_first: Iterable[str] = (),
    renamed: dict[str, str] | None = None,
) -> tuple[Attribute, ...]:
    keys = renamed or {}
    return tuple(
        [Attribute(n, keys.get(n, n)) for n in model_first]
        + [Attribute(n, keys.get(n, n), True) for n in product_first]
    )


# The attributes of the product table and their precedence.
# ``release_l1`` reads the key ``golden_record_level1``.
PRODUCT_ATTRIBUTES = attributes(
    model_first=(
        "title",
        "detail_type_single_unit",
        "type_single_unit",
        "net_content",
        "release_l1",
        "foto_release_hash",
        "amount_single_unit",
        "net_content_uom",
        "type_packaging_unit",
        "structure_packaging_unit",
        "shop_enabled",
        "gtin_single_unit",
        "gtin_packaging_unit",
        "detail_type_packaging_unit",
    ),
    product_first=(
        "brand",
        "manufacturer_name",
        "status_base",
        "net_content_liter",
        "contact_info",
        "golden_record_level1",
    ),
    renamed={"release_l1": "golden_record_level1"},
)


def is_manual(code: Column) -> Column:
    """Manually kept models have codes that begin with ``m-``; no code means no."""
    return F.coalesce(code.like("m-%"), F.lit(False))


def model_levels(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per model with its own values, filled up from its parent.

    Both precedence orders of a product put the model directly ahead of its
    parent, so the two levels are folded here, on the small table, and the product
    table is joined once. Documents are parsed before the join: only the values
    move, never the documents.
    """
    keys = list(dict.fromkeys(keys))
    parsed = models.select(
        "id", "parent_id", "code", parse_attributes(F.col("raw_values"), keys).alias("_v")
    ).select(
        "id", "parent_id", "code", *[attribute_value("_v", k).alias(f"_m_{k}") for k in keys]
    )
    parents = parsed.select(
        F.col("id").alias("_parent_id"),
        F.col("code").alias("_parent_code"),
        *[F.col(f"`_m_{k}`").alias(f"_p_{k}") for k in keys],
    )
    joined = parsed.join(parents, F.col("parent_id") == F.col("_parent_id"), "left")
    return joined.select(
        F.col("id").alias("_model_id"),
        F.coalesce("code", "_parent_code").alias("l1_code"),
        F.coalesce("_parent_code", "code").alias("base_code"),
        *[F.coalesce(F.col(f"`_m_{k}`"), F.col(f"`_p_{k}`")).alias(f"_m_{k}") for k in keys],
    )


def resolve_attributes(
    products: DataFrame,
    models: DataFrame,
    wanted: Sequence[Attribute] = PRODUCT_ATTRIBUTES,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Add one column per attribute, ``l1_code``, ``base_code`` and ``is_manual``.

    ``products`` has ``product_model_id`` and ``raw_values``; every other column is
    kept, those two are not. ``extra_keys`` are further keys to read from the same
    single parse of the product document; they come back as fields of ``_values``.
    Where the model id is unique a product gives exactly one row.
    """
    keys = list(dict.fromkeys(a.key for a in wanted))
    kept = [c for c in products.columns if c not in ("raw_values", "product_model_id")]
    own = (
        products.select(
            *kept,
            "product_model_id",
            parse_attributes(F.col("raw_values"), [*keys, *extra_keys]).alias("_v"),
        )
        .select(
            *kept,
            "product_model_id",
            *[attribute_value("_v", k).alias(f"_o_{k}") for k in keys],
            *(
                [F.struct(*[attribute_value("_v", k).alias(k) for k in extra_keys]).alias("_values")]
                if extra_keys
                else []
            ),
        )
    )
    joined = own.join(
        model_levels(models, keys), F.col("product_model_id") == F.col("_model_id"), "left"
    )

    def resolved(a: Attribute) -> Column:
        own_value, model_value = F.col(f"`_o_{a.key}`"), F.col(f"`_m_{a.key}`")
        pair = (own_value, model_value) if a.product_first else (model_value, own_value)
        return without_quotes(F.coalesce(*pair)).alias(a.name)

    return joined.select(
        *kept,
        *[resolved(a) for a in wanted],
        without_quotes(F.col("l1_code")).alias("l1_code"),
        F.col("base_code"),
        is_manual(F.col("l1_code")).alias("is_manual"),
        *(["_values"] if extra_keys else []),
    )
