"""The wide product table: full build and daily changes."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from skuweave.functions.dates import AsOf
from skuweave.operators.attributes import PRODUCT_ATTRIBUTES, resolve_attributes
from skuweave.operators.columns import columns_first, drop_columns, restrict_and_enrich
from skuweave.operators.dedup import keep_one, max_per_key
from skuweave.operators.flags import (
    EXCLUDED_FROM_COLUMNS,
    count_true,
    merchant_columns,
    merchant_document_keys,
    population_change,
    sorted_keys,
    union_keys,
    without_keys,
)
from skuweave.operators.scans import changed_rows
from skuweave.operators.translate import (
    PRODUCT_PASSES,
    option_values,
    translate_codes,
    unique_lookup,
)
from skuweave.session import cut_lineage

# Fixed value: added to the number of enabled merchants.
ENABLEMENT_OFFSET = -2

# Helper columns that do not reach the product table.
DROPPED = (
    "title_2", "net_content_2", "brand_2", "net_content_liter_2", "contact_info_2",
    "raw_values_model", "raw_values", "raw_values_product",
    "family_id", "product_model_id", "family_variant_id",
    "is_enabled", "merchant_key_id", "merchant_key_enabled",
)


@dataclass(frozen=True)
class ProductSources:
    products: DataFrame
    models: DataFrame
    distributor: DataFrame
    options: DataFrame
    option_values: DataFrame
    categories: DataFrame
    merchants_new: DataFrame
    merchants_active: DataFrame


def merchant_keys(sources: ProductSources) -> list[str]:
    keys = union_keys(sources.merchants_new, sources.merchants_active)
    return sorted_keys(without_keys(keys, "merchant_key", EXCLUDED_FROM_COLUMNS))


def changed_products(sources: ProductSources, as_of: AsOf, days: int = 4) -> DataFrame:
    """Products changed or created lately, themselves or in their model."""
    return changed_rows(
        sources.products, sources.models, "product_model_id", "id", as_of=as_of, days=days
    )


def product_table(
    sources: ProductSources,
    products: DataFrame | None = None,
    keys: list[str] | None = None,
    with_manufacturer_mark: bool = True,
    offset: int = ENABLEMENT_OFFSET,
) -> DataFrame:
    """One wide row per product that has a category.

    Repeated identifiers are reduced right after the hierarchy is resolved, over
    the whole table and with the latest update first. That leaves the rows
    partitioned by identifier, and the distributor maxima and the categories are
    joined on the same key without moving the wide rows again.
    """
    products = sources.products if products is None else products
    keys = merchant_keys(sources) if keys is None else keys

    kept = [c for c in products.columns if c not in DROPPED or c in ("raw_values", "product_model_id")]
    resolved = resolve_attributes(
        products.select(*kept), sources.models, PRODUCT_ATTRIBUTES, merchant_document_keys(keys)
    )
    wide = keep_one(resolved, ["identifier"], [F.col("updated").desc(), F.col("created").desc()])
    distributor = max_per_key(sources.distributor, "sku").withColumnRenamed("sku", "sku_gfghdata")
    wide = wide.join(distributor, F.col("identifier") == F.col("sku_gfghdata"), "left")
    categories = keep_one(sources.categories, ["sku"])
    wide = restrict_and_enrich(wide, categories, "identifier", "sku")
    if with_manufacturer_mark:
        wide = wide.withColumn(
            "manufacturer_gfgh_data", F.concat(F.lit("|"), F.col("manufacturer"), F.lit("|"))
        )
    lookup = cut_lineage(unique_lookup(option_values(sources.options, sources.option_values)))
    wide = translate_codes(wide, lookup, PRODUCT_PASSES)
    columns = [c for c in wide.columns if c != "_values"]
    if keys:
        wide = wide.select(*columns, *merchant_columns("_values", keys))
    wide = wide.withColumn("enablement", count_true([f"{k}_enabled" for k in keys], offset))
    return columns_first(drop_columns(wide, DROPPED), ["identifier"])


def restricted(sources: ProductSources, products: DataFrame) -> ProductSources:
    """The sources' rows that concern ``products``: their skus, models and parents.

    Only keys are compared, before anything is aggregated, ranked or parsed.
    """
    skus = products.select(F.col("identifier").alias("sku")).distinct()
    own = products.select(F.col("product_model_id").alias("id"))
    models = sources.models
    parents = models.join(own, "id", "left_semi").select(F.col("parent_id").alias("id"))
    wanted = cut_lineage(own.union(parents).where("id is not null").distinct())
    return replace(
        sources,
        distributor=sources.distributor.join(skus, "sku", "left_semi"),
        categories=sources.categories.join(skus, "sku", "left_semi"),
        models=models.join(wanted, "id", "left_semi"),
    )


def full_load(sources: ProductSources, **settings) -> DataFrame:
    return product_table(sources, **settings)


def delta_rows(sources: ProductSources, as_of: AsOf, days: int = 4, **settings) -> tuple[DataFrame, DataFrame]:
    """The changed products' keys, and the rows that take the place of theirs."""
    # Used for the new rows and for removing the old ones; finding it scans all products.
    changed = cut_lineage(changed_products(sources, as_of, days))
    settings.setdefault("with_manufacturer_mark", False)
    rows = product_table(restricted(sources, changed), products=changed, **settings)
    return changed.select("identifier").distinct(), rows


def delta_load(
    target: DataFrame, sources: ProductSources, as_of: AsOf, days: int = 4, **settings
) -> DataFrame:
    """The product table after the changed products have replaced their old rows.

    A changed product that lost its category is removed from the table, as its
    old row is deleted and no new one is built.
    """
    changed, rows = delta_rows(sources, as_of, days, **settings)
    kept = target.join(changed, "identifier", "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def needs_full_load(sources: ProductSources, state: DataFrame) -> DataFrame:
    """``(merchant_count, changed)``: a new merchant changes the width of the table."""
    return population_change(union_keys(sources.merchants_new, sources.merchants_active), state)
