"""Matching input names against the product table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skuweave.functions.numbers import number, refuse, unparsed
from skuweave.functions.text import joined_name
from skuweave.operators.dedup import keep_one
from skuweave.operators.fuzzy import fuzzy_match
from skuweave.operators.tfidf import tfidf_match
from skuweave.plans.store import store
from skuweave.session import cut_lineage, together

# Fixed value: products of this type are not offered as matches.
EXCLUDED_TYPE = "FREAK (abweichendes Design, Rücksprache halten)"


def edit_catalog(all_skus: DataFrame) -> DataFrame:
    """``title brand amountxcontent`` as the name, and the unit fields as text."""
    return all_skus.select(
        "identifier",
        joined_name(
            F.col("title"), F.lit(" "), F.col("brand"), F.lit(" "),
            F.col("amount_single_unit"), F.lit("x"), F.col("net_content_liter"),
        ).alias("name"),
        F.col("base_unit_content").cast("string").alias("base_unit_content"),
        F.col("no_of_base_units").cast("string").alias("no_of_base_units"),
    )


def match_by_edit_ratio(all_skus: DataFrame, inputs: DataFrame, min_ratio: int = 70) -> DataFrame:
    """All inputs are matched against the whole table."""
    return fuzzy_match(edit_catalog(all_skus), inputs, min_ratio)


def tfidf_catalog(all_skus: DataFrame) -> DataFrame:
    """Enabled products with content and base code, named ``brand title amountxcontent``."""
    return all_skus.where(
        (F.col("enablement") > 0)
        & (F.col("type_single_unit") != EXCLUDED_TYPE)
        & F.col("net_content").isNotNull()
        & F.col("base_code").isNotNull()
    ).select(
        F.col("identifier").alias("sku"),
        "base_code",
        "amount_single_unit",
        "net_content",
        "enablement",
        joined_name(
            F.col("brand"), F.lit(" "), F.col("title"), F.lit(" "),
            F.col("amount_single_unit"), F.lit("x"), F.col("net_content"),
        ).alias("sku_title"),
    )


# The text columns that become numbers, by the side that has them.
_PRODUCT_NUMBERS = {"amount_single_unit": "int", "net_content": "double"}
_INPUT_NUMBERS = {"no_of_base_units": "int"}


def _decimal_point(column: str) -> Column:
    return F.replace(column, F.lit(","), F.lit(".")) if column == "net_content" else F.col(column)


def matched_rows(
    matches: DataFrame, catalog: DataFrame, inputs: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matches, and the products and inputs that they name, each written once.

    What is written is what later steps parse: neither Spark's optimizer nor a second
    run of the matching can bring other rows into it.
    """
    matches = cut_lineage(matches)
    products, asked = together(
        lambda: cut_lineage(
            catalog.join(matches.select(F.col("name_all_skus").alias("sku_title")), "sku_title", "left_semi")
        ),
        lambda: cut_lineage(inputs.join(matches.select(F.col("name_input").alias("name")), "name", "left_semi")),
    )
    return matches, products, asked


def number_rejects(products: DataFrame, asked: DataFrame) -> DataFrame:
    """``(side, key, column, text, reason)``: matched rows whose numbers do not parse."""
    return unparsed(products, "sku", _PRODUCT_NUMBERS, "catalogue", _decimal_point).unionByName(
        unparsed(asked, "gfgh_id", _INPUT_NUMBERS, "input", _decimal_point)
    )


def attach_matches(
    matches: DataFrame, catalog: DataFrame, inputs: DataFrame, tolerant: bool = False
) -> DataFrame:
    """One row per input whose best name has a product with the same number of units.

    Only products and inputs that were matched are parsed. Where one of their numbers
    does not parse, the rejects are counted (``number_rejects`` lists them) and the job
    ends; where ``tolerant``, such a number is null and a row without units matches
    nothing. Of the products with one name and unit count only the smallest sku can be
    the result, so they are reduced to it before the join. The answer is found once per
    distinct input name and unit count and attached to the inputs last, so copies of a
    name on either side do not multiply.
    """
    matches, catalog, inputs = matched_rows(matches, catalog, inputs)
    if not tolerant:
        refuse(number_rejects(catalog, inputs))
    products = (
        catalog.select(
            "sku",
            F.col("sku_title").alias("name_all_skus"),
            number(F.col("amount_single_unit"), "int").alias("units"),
            number(_decimal_point("net_content"), "double").alias("base_unit_content_all_skus"),
        )
        .where(F.col("units").isNotNull())
        .groupBy("name_all_skus", "units")
        .agg(F.min(F.struct("sku", "base_unit_content_all_skus")).alias("_first"))
        .select("name_all_skus", "units", "_first.*")
    )
    asked = inputs.select(
        "gfgh_id",
        F.col("name").alias("name_input"),
        number(F.col("no_of_base_units"), "int").alias("units"),
        F.col("base_unit_content").alias("base_unit_content_input"),
    )
    answers = (
        asked.select("name_input", "units").distinct()
        .join(matches, "name_input")
        .join(products, ["name_all_skus", "units"])
    )
    found = asked.join(answers, ["name_input", "units"]).select(
        "sku",
        "gfgh_id",
        "name_input",
        F.col("units").alias("no_of_base_units_input"),
        "base_unit_content_input",
        "name_all_skus",
        F.col("units").alias("no_of_base_units_all_skus"),
        "base_unit_content_all_skus",
        "similarity",
    )
    return keep_one(found, ["gfgh_id"], [F.desc("similarity"), "sku"])


def match_by_tfidf(
    all_skus: DataFrame, inputs: DataFrame, min_score: float = 0.5, tolerant: bool = False
) -> DataFrame:
    catalog = tfidf_catalog(all_skus)
    return attach_matches(tfidf_match(catalog, inputs, min_score=min_score), catalog, inputs, tolerant)


def run_matching(all_skus: DataFrame, inputs: DataFrame, table: str, root: str, by: str = "edit", **options) -> int:
    """Match all inputs and replace the result table; returns the number of matches.

    ``by`` is ``edit`` for the edit ratio or ``tfidf`` for the cosine of n-grams; options go
    to that matcher. The table is replaced when all matches are written, so a run that
    fails leaves the earlier result.
    """
    matchers = {"edit": match_by_edit_ratio, "tfidf": match_by_tfidf}
    if by not in matchers:
        raise ValueError(f"match by one of {sorted(matchers)}, not {by}")
    return store(matchers[by](all_skus, inputs, **options), table, root)
