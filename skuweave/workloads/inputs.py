"""Inputs of the operators, derived from the driver tables.

Where an operator needs product documents or option codes, they are computed from
whole driver tables by expressions that Spark and the SQL counterpart share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCOPE_OPEN = '{"<all_channels>":{"<all_locales>":'


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def derive_sql(source: str, columns: dict[str, str], distinct: bool = False) -> str:
    listed = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT {'DISTINCT ' if distinct else ''}{listed} FROM {source}"


def text_entry(key: str, value: str) -> str:
    """SQL text of one document entry; a null value leaves the entry out."""
    return f"""'"{key}":{SCOPE_OPEN}"' || {value} || '"}}}}'"""


def plain_entry(key: str, value: str) -> str:
    return f"""'"{key}":{SCOPE_OPEN}' || {value} || '}}}}'"""


def document(*entries: str) -> str:
    return f"'{{' || concat_ws(',', {', '.join(entries)}) || '}}'"


MERCHANTS = ("alpha", "beta", "beta_id_2", "gamma")

# Where each attribute is set, so that all levels and both precedences occur.
_QUOTED = "p_name || ' ' || chr(92) || chr(34) || p_size || chr(92) || chr(34)"
PRODUCT_DOCUMENT = document(
    text_entry("title", _QUOTED),
    text_entry("brand", "CASE WHEN p_size % 2 = 0 THEN p_brand END"),
    text_entry("manufacturer_name", "CASE WHEN p_size % 3 = 0 THEN p_type END"),
    text_entry("type_single_unit", "p_type"),
    text_entry("net_content", "p_size || ',5'"),
    text_entry("net_content_liter", "'l' || p_size % 7"),
    plain_entry("amount_single_unit", "CAST(p_size % 5 AS VARCHAR(10))"),
    text_entry("net_content_uom", "CASE WHEN p_size > 10 THEN 'u' || p_size % 4 END"),
    text_entry("golden_record_level1", "CASE WHEN p_size < 25 THEN 'g' || p_size % 2 END"),
    plain_entry("status_base", "CASE WHEN p_size > 40 THEN 'null' WHEN p_size > 20 THEN 'true' END"),
    text_entry("gtin_single_unit", "CAST(p_partkey AS VARCHAR(20))"),
    *[
        entry
        for i, m in enumerate(MERCHANTS)
        for entry in (
            plain_entry(
                f"gfgh_{m}_enabled",
                f"CASE WHEN p_size % {i + 2} = 0 THEN 'true' WHEN p_size % {i + 3} = 0 THEN 'false' END",
            ),
            text_entry(f"gfgh_{m}_id", f"CASE WHEN p_size % {i + 2} = 1 THEN 'id' || p_partkey END"),
            text_entry(f"freigabe_{m}_id", f"CASE WHEN p_size % {i + 4} = 0 THEN 'f' || p_size END"),
        )
    ],
)
_TYPE_NUMBER = "CAST(ascii(p_type) + length(p_type) AS INT)"
_BRAND_NUMBER = "CAST(replace(p_brand, 'Brand#', '') AS INT)"
_DAY = "TIMESTAMP '2024-01-01 00:00:00'"

PRODUCTS = {
    "identifier": "'sku' || p_partkey",
    "product_model_id": f"CASE WHEN p_size % 10 <> 0 THEN {_BRAND_NUMBER} * 1000 + {_TYPE_NUMBER} END",
    "family_id": "p_size % 6",
    "raw_values": PRODUCT_DOCUMENT,
    "created": f"{_DAY} + INTERVAL '1' DAY * p_size",
    "updated": f"{_DAY} + INTERVAL '1' DAY * (p_size + p_size % 9)",
}
MODELS = {
    "id": f"{_BRAND_NUMBER} * 1000 + {_TYPE_NUMBER}",
    "parent_id": f"CASE WHEN p_type <> 'SMALL' THEN 100000 + {_TYPE_NUMBER} END",
    "code": f"CASE WHEN {_BRAND_NUMBER} % 4 = 0 THEN 'm-' || p_type WHEN {_BRAND_NUMBER} % 4 = 1 THEN 'model ' || p_brand END",
    "raw_values": document(
        text_entry("title", f"CASE WHEN {_BRAND_NUMBER} % 3 = 0 THEN 'title ' || p_brand END"),
        text_entry("brand", "p_brand || ' of model'"),
        text_entry("net_content_uom", f"CASE WHEN {_BRAND_NUMBER} % 2 = 0 THEN 'u1' END"),
        text_entry("structure_packaging_unit", "'s' || length(p_brand)"),
        text_entry("golden_record_level1", f"CASE WHEN {_BRAND_NUMBER} % 5 = 0 THEN 'g1' END"),
    ),
    "created": f"{_DAY} + INTERVAL '1' DAY * ({_BRAND_NUMBER} % 20)",
    "updated": f"{_DAY} + INTERVAL '1' DAY * ({_BRAND_NUMBER} % 20 + {_BRAND_NUMBER} * 2)",
}
PARENTS = {
    "id": f"100000 + {_TYPE_NUMBER}",
    "parent_id": "CAST(NULL AS INT)",
    "code": "CASE WHEN p_type = 'PROMO' THEN 'm-promo' ELSE 'parent ' || p_type END",
    "raw_values": document(
        text_entry("title", "CASE WHEN p_type = 'LARGE' THEN 'title ' || p_type END"),
        text_entry("brand", "'brand of ' || p_type"),
        text_entry("manufacturer_name", "'maker of ' || p_type"),
        text_entry("type_packaging_unit", "'t' || length(p_type)"),
        text_entry("foto_release_hash", "CASE WHEN p_type <> 'MEDIUM' THEN 'h' || length(p_type) END"),
        plain_entry("shop_enabled", "'true'"),
    ),
    "created": _DAY,
    "updated": _DAY,
}


def product_frames(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, folder, "part")
    models = derive(part, MODELS).distinct().unionByName(derive(part, PARENTS).distinct())
    return derive(part, PRODUCTS), models


PRODUCT_CTES = (
    f"products AS ({derive_sql('part', PRODUCTS)}), "
    f"models AS ({derive_sql('part', MODELS, True)} UNION ALL {derive_sql('part', PARENTS, True)})"
)

# Option codes: the letters the documents use, with a second value for some codes
# and values of ``u`` codes that are codes themselves.
OPTIONS = {
    "id": "p_size",
    "code": "CASE WHEN p_size < 10 THEN 'l' || p_size WHEN p_size < 20 THEN 'u' || p_size % 10 "
    "WHEN p_size < 30 THEN 'g' || p_size % 10 WHEN p_size < 40 THEN 's' || p_size % 10 "
    "ELSE 't' || p_size % 10 END",
}
OPTION_VALUES = {
    "option_id": "p_size",
    "value": "CASE WHEN p_size < 10 THEN '0.' || p_size WHEN p_size < 20 THEN 'l' || p_size % 10 "
    "ELSE 'option ' || p_size % 10 || CASE WHEN p_size % 3 = 0 THEN ' ' || p_type ELSE '' END END",
}
DISTRIBUTOR = {
    "sku": "CASE WHEN l_linenumber <> 7 THEN 'sku' || l_partkey END",
    "base_unit_content": "CAST(CAST(l_quantity AS INT) AS VARCHAR(10))",
    "no_of_base_units": "CAST(l_linenumber AS VARCHAR(10))",
    "manufacturer": "CASE WHEN l_returnflag <> 'A' THEN l_returnflag || l_linestatus END",
    "refund_value": "l_discount",
    "name": "'item ' || l_suppkey",
    "active": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END",
}
CATEGORIES = {
    "sku": "CASE WHEN l_quantity > 48 THEN 'sku' || l_partkey END",
    "title": "'collides'",
    "category_l1": "'category ' || l_partkey % 11",
}
MERCHANTS_NEW = {"merchant_key": "CASE WHEN p_size % 6 = 0 THEN 'alpha' WHEN p_size % 6 = 1 THEN 'beta' "
                 "WHEN p_size % 6 = 2 THEN 'trinkkontor' WHEN p_size % 6 = 3 THEN 'merchant_key' "
                 "WHEN p_size % 6 = 4 THEN 'gamma' END"}
MERCHANTS_ACTIVE = {"merchant_key": "CASE WHEN p_size % 3 = 0 THEN 'beta_id_2' "
                    "WHEN p_size % 3 = 1 THEN 'trinkkontor_trr' ELSE 'alpha' END"}
