"""Queries on the product table and its parts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from skuweave.functions.json_values import json_attribute, parse_attributes
from skuweave.operators.attributes import PRODUCT_ATTRIBUTES, resolve_attributes
from skuweave.operators.columns import restrict_and_enrich
from skuweave.operators.dedup import attach_max_per_key, keep_one
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
from skuweave.operators.translate import (
    PRODUCT_PASSES,
    option_values,
    translate_codes,
    unique_lookup,
)
from skuweave.plans.products import ProductSources, changed_products, delta_load, full_load
from skuweave.plans.store import run_products
from skuweave.session import new_folder
from skuweave.sources.tables import read_stored
from skuweave.workloads import inputs as given
from skuweave.workloads.inputs import derive, derive_sql, document, plain_entry, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


# --- hierarchy -------------------------------------------------------------------


def _path(alias: str, key: str) -> str:
    return f"""json_extract_string({alias}.raw_values, '$."{key}"."<all_channels>"."<all_locales>"')"""


def _resolved_sql(attribute) -> str:
    levels = ("p", "m", "mm") if attribute.product_first else ("m", "mm", "p")
    values = ", ".join(_path(level, attribute.key) for level in levels)
    return f"replace(coalesce({values}), '\"', '') AS {attribute.name}"


_RESOLVED = ", ".join(_resolved_sql(a) for a in PRODUCT_ATTRIBUTES)
_HIERARCHY = "FROM products p LEFT JOIN models m ON m.id = p.product_model_id LEFT JOIN models mm ON mm.id = m.parent_id"
_CODES = (
    "coalesce(m.code, mm.code) AS l1_code, coalesce(mm.code, m.code) AS base_code, "
    "coalesce(coalesce(m.code, mm.code) LIKE 'm-%', false) AS is_manual"
)


@query(
    f"WITH {given.PRODUCT_CTES} SELECT DISTINCT p.identifier, p.family_id, p.created, p.updated, "
    f"{_RESOLVED}, {_CODES} {_HIERARCHY}"
)
def resolve_product_attributes(spark: SparkSession, folder: str) -> DataFrame:
    products, models = given.product_frames(spark, folder)
    return resolve_attributes(products, models).distinct()


_K = plain_entry("k", "value")


@query(
    f"""SELECT event_id, json_extract_string({document(_K)}, '$."k"."<all_channels>"."<all_locales>"') AS k FROM events"""
)
def json_extract(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").selectExpr("event_id", f"{document(_K)} AS doc")
    return events.select("event_id", json_attribute(F.col("doc"), "k").alias("k"))


# --- aggregates and deduplication ------------------------------------------------


@query(
    "SELECT p_partkey, p_name, d.* FROM part LEFT JOIN (SELECT l_partkey, max(l_quantity) AS l_quantity, "
    "max(l_extendedprice) AS l_extendedprice, max(l_returnflag) AS l_returnflag, "
    "max(l_shipdate) AS l_shipdate FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey) d "
    "ON d.l_partkey = p_partkey"
)
def max_per_key_join(spark: SparkSession, folder: str) -> DataFrame:
    return attach_max_per_key(
        table(spark, folder, "part").select("p_partkey", "p_name"),
        table(spark, folder, "lineitem"),
        "p_partkey",
        "l_partkey",
        ["l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"],
    )


_LINE = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


@query(
    f"SELECT {', '.join(_LINE)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY "
    f"l_shipdate DESC, {', '.join(c for c in _LINE if c != 'l_orderkey')}) AS n FROM lineitem) WHERE n = 1"
)
def keep_one_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return keep_one(table(spark, folder, "lineitem"), ["l_orderkey"], [F.desc("l_shipdate")])


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    "SELECT part.*, f.l_partkey, f.category FROM part JOIN (SELECT DISTINCT CASE WHEN l_quantity > 45 "
    "THEN l_partkey END AS l_partkey, 'category ' || l_partkey % 7 AS category FROM lineitem) f "
    "ON f.l_partkey = p_partkey"
)
def category_restrict(spark: SparkSession, folder: str) -> DataFrame:
    facts = (
        table(spark, folder, "lineitem")
        .selectExpr(
            "CASE WHEN l_quantity > 45 THEN l_partkey END AS l_partkey",
            "'category ' || l_partkey % 7 AS category",
            "'other' AS p_name",
        )
        .distinct()
    )
    return restrict_and_enrich(table(spark, folder, "part"), facts, "p_partkey", "l_partkey")


# --- code translation ------------------------------------------------------------

_NATION_OPTIONS = {"id": "n_nationkey", "code": "CAST(n_nationkey AS VARCHAR(10))"}
_NATION_VALUES = {"option_id": "n_nationkey", "value": "n_name"}
_SECOND_VALUES = {"option_id": "n_nationkey", "value": "n_name || ' again'"}
_CODED = {
    "c_custkey": "c_custkey",
    "region": "CAST(c_nationkey AS VARCHAR(10))",
    "nation": "CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS VARCHAR(10)) END",
    "segment": "c_mktsegment",
}


@query(
    f"WITH options AS ({derive_sql('nation', _NATION_OPTIONS)} UNION ALL SELECT 1000 + n_nationkey, n_name FROM nation), "
    f"vals AS ({derive_sql('nation', _NATION_VALUES)} UNION ALL {derive_sql('nation', _SECOND_VALUES)} "
    "UNION ALL SELECT 1000 + n_nationkey, r_name FROM nation JOIN region ON r_regionkey = n_regionkey), "
    "lookup AS (SELECT code, min(value) AS value FROM options LEFT JOIN vals ON option_id = id GROUP BY code), "
    f"coded AS ({derive_sql('customer', _CODED)}) "
    "SELECT c_custkey, coalesce(r2.value, r1.value, region) AS region, coalesce(n1.value, nation) AS nation, "
    "coalesce(s1.value, segment) AS segment FROM coded "
    "LEFT JOIN lookup r1 ON r1.code = region LEFT JOIN lookup r2 ON r2.code = r1.value "
    "LEFT JOIN lookup n1 ON n1.code = nation LEFT JOIN lookup s1 ON s1.code = segment"
)
def translate_option_codes(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    options = derive(nation, _NATION_OPTIONS).union(nation.selectExpr("1000 + n_nationkey", "n_name"))
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    values = (
        derive(nation, _NATION_VALUES).union(derive(nation, _SECOND_VALUES))
        .union(named.selectExpr("1000 + n_nationkey", "r_name"))
    )
    lookup = unique_lookup(option_values(options, values))
    coded = derive(table(spark, folder, "customer"), _CODED)
    return translate_codes(coded, lookup, {"region": 2, "nation": 1, "segment": 1})


@query(
    f"WITH lookup AS ({derive_sql('nation', {'code': _NATION_OPTIONS['code'], 'value': 'n_name'})}), "
    f"coded AS ({derive_sql('customer', _CODED)}) "
    "SELECT c_custkey, coalesce(a.value, region) AS region, coalesce(b.value, nation) AS nation, segment "
    "FROM coded LEFT JOIN lookup a ON a.code = region LEFT JOIN lookup b ON b.code = nation"
)
def translate_large_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The form beyond the broadcast bound, which is set to nothing here."""
    lookup = derive(table(spark, folder, "nation"), {"code": _NATION_OPTIONS["code"], "value": "n_name"})
    coded = derive(table(spark, folder, "customer"), _CODED)
    return translate_codes(coded, lookup, {"region": 1, "nation": 1}, rows=0)


# --- merchant columns ------------------------------------------------------------

_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
_EVENT_DOCUMENT = (
    """'{"gfgh_' || event_type || '_enabled":{"<all_channels>":{"<all_locales>":' || (value > 20) || '}},"gfgh_' """
    """|| event_type || '_id":{"<all_channels>":{"<all_locales>":"' || user_id || '"}},"freigabe_' || event_type """
    """|| '_id":{"<all_channels>":{"<all_locales>":"' || event_id || '"}}}'"""
)


def _merchant_sql(key: str) -> str:
    def value(name: str) -> str:
        return f"""json_extract_string(doc, '$."{name}"."<all_channels>"."<all_locales>"')"""

    return (
        f"coalesce({value(f'gfgh_{key}_enabled')} = 'true', false) AS {key}_enabled, "
        f"{value(f'gfgh_{key}_id')} AS {key}_id, {value(f'freigabe_{key}_id')} AS {key}_freigabe"
    )


@query(
    f"WITH docs AS (SELECT event_id, {_EVENT_DOCUMENT} AS doc FROM events), "
    f"wide AS (SELECT event_id, {', '.join(_merchant_sql(t) for t in _EVENT_TYPES)} FROM docs) "
    f"SELECT *, CAST({' + '.join(f'{t}_enabled::INT' for t in _EVENT_TYPES)} - 2 AS INT) AS enablement FROM wide"
)
def dynamic_flags(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    recent = events.selectExpr("event_type AS merchant_key")
    other = events.selectExpr("CASE WHEN value > 50 THEN 'trinkkontor' ELSE event_type END AS merchant_key")
    keys = sorted_keys(without_keys(union_keys(recent, other), "merchant_key", EXCLUDED_FROM_COLUMNS))
    parsed = events.selectExpr("event_id", f"{_EVENT_DOCUMENT} AS doc").select(
        "event_id", parse_attributes(F.col("doc"), merchant_document_keys(keys)).alias("_v")
    )
    values = parsed.select(
        "event_id",
        F.struct(
            *[
                F.col(f"_v.`{k}`.`<all_channels>`.`<all_locales>`").alias(k)
                for k in merchant_document_keys(keys)
            ]
        ).alias("_values"),
    )
    return values.select("event_id", *merchant_columns("_values", keys)).withColumn(
        "enablement", count_true([f"{k}_enabled" for k in keys], offset=-2)
    )


_KEYS_NEW = {"merchant_key": "CASE WHEN c_nationkey < 20 THEN 'm' || c_nationkey WHEN c_nationkey = 20 THEN 'trinkkontor' END"}
_KEYS_ACTIVE = {"merchant_key": "CASE WHEN s_nationkey > 15 THEN 'm' || s_nationkey ELSE 'merchant_key' END"}


@query(
    f"SELECT merchant_key FROM ({derive_sql('customer', _KEYS_NEW)} UNION {derive_sql('supplier', _KEYS_ACTIVE)}) "
    "WHERE merchant_key IS NULL OR merchant_key NOT IN ('trinkkontor', 'trinkkontor_trr', 'merchant_key')"
)
def active_keys(spark: SparkSession, folder: str) -> DataFrame:
    keys = union_keys(
        derive(table(spark, folder, "customer"), _KEYS_NEW),
        derive(table(spark, folder, "supplier"), _KEYS_ACTIVE),
    )
    return without_keys(keys, "merchant_key", EXCLUDED_FROM_COLUMNS)


@query(
    f"WITH keys AS ({derive_sql('customer', _KEYS_NEW)} UNION {derive_sql('supplier', _KEYS_ACTIVE)}), "
    "n AS (SELECT count(*) AS merchant_count FROM keys WHERE merchant_key IS NULL "
    "OR merchant_key NOT IN ('trinkkontor', 'trinkkontor_trr')) "
    "SELECT merchant_count, merchant_count <> (SELECT count(*) FROM nation) AS changed FROM n"
)
def merchant_population_change(spark: SparkSession, folder: str) -> DataFrame:
    keys = union_keys(
        derive(table(spark, folder, "customer"), _KEYS_NEW),
        derive(table(spark, folder, "supplier"), _KEYS_ACTIVE),
    )
    state = table(spark, folder, "nation").agg(F.count(F.lit(1)).alias("merchant_count"))
    return population_change(keys, state)


# --- the product table -----------------------------------------------------------

AS_OF = "2024-03-01"


def product_sources(spark: SparkSession, folder: str) -> ProductSources:
    products, models = given.product_frames(spark, folder)
    part, lines = table(spark, folder, "part"), table(spark, folder, "lineitem")
    return ProductSources(
        products=products,
        models=models,
        distributor=derive(lines, given.DISTRIBUTOR),
        options=derive(part, given.OPTIONS).distinct(),
        option_values=derive(part, given.OPTION_VALUES).distinct(),
        categories=derive(lines, given.CATEGORIES),
        merchants_new=derive(part, given.MERCHANTS_NEW),
        merchants_active=derive(part, given.MERCHANTS_ACTIVE),
    )


_MAXIMA = [c for c in given.DISTRIBUTOR if c != "sku"]


def _translated_sql(name: str, passes: int) -> str:
    looked_up = ", ".join(f"t_{name}_{i}.value" for i in reversed(range(passes)))
    return f"coalesce({looked_up}, r.{name}) AS {name}"


def _translation_joins() -> str:
    joins = []
    for name, passes in PRODUCT_PASSES.items():
        for i in range(passes):
            left = f"r.{name}" if i == 0 else f"t_{name}_{i - 1}.value"
            joins.append(f"LEFT JOIN lookup t_{name}_{i} ON t_{name}_{i}.code = {left}")
    return " ".join(joins)


def _product_table_sql(products: str = "products", mark: bool = True) -> str:
    """The product table as one statement over the CTEs before it."""
    columns = [
        _translated_sql(a.name, PRODUCT_PASSES[a.name]) if a.name in PRODUCT_PASSES else f"r.{a.name}"
        for a in PRODUCT_ATTRIBUTES
    ]
    flags = ", ".join(
        f"coalesce({_path('r', f'gfgh_{m}_enabled')} = 'true', false) AS {m}_enabled, "
        f"{_path('r', f'gfgh_{m}_id')} AS {m}_id, {_path('r', f'freigabe_{m}_id')} AS {m}_freigabe"
        for m in given.MERCHANTS
    )
    counted = " + ".join(f"{m}_enabled::INT" for m in given.MERCHANTS)
    marked = "'|' || d.manufacturer || '|' AS manufacturer_gfgh_data, " if mark else ""
    return (
        f"r AS (SELECT p.identifier, p.created, p.updated, p.raw_values, {_RESOLVED}, {_CODES} "
        f"{_HIERARCHY.replace('products p', f'{products} p')}), "
        "d AS (SELECT sku AS sku_gfghdata, "
        f"{', '.join(f'max({c}) AS {c}' for c in _MAXIMA)} FROM distributor WHERE sku IS NOT NULL GROUP BY sku), "
        "wide AS (SELECT r.identifier, r.created, r.updated, "
        f"{', '.join(columns)}, l1_code, base_code, is_manual, d.*, {marked}c.category_l1, c.sku, {flags} "
        "FROM r LEFT JOIN d ON d.sku_gfghdata = r.identifier JOIN categories c ON c.sku = r.identifier "
        f"{_translation_joins()}), "
        f"product_table AS (SELECT *, CAST({counted} - 2 AS INT) AS enablement FROM wide)"
    )


_SOURCE_CTES = (
    f"{given.PRODUCT_CTES}, distributor AS ({derive_sql('lineitem', given.DISTRIBUTOR)}), "
    f"options AS ({derive_sql('part', given.OPTIONS, True)}), "
    f"vals AS ({derive_sql('part', given.OPTION_VALUES, True)}), "
    "lookup AS (SELECT code, min(value) AS value FROM options LEFT JOIN vals ON option_id = id "
    "GROUP BY code HAVING min(value) IS NOT NULL), "
    f"categories AS ({derive_sql('lineitem', given.CATEGORIES, True)})"
)


@query(f"WITH {_SOURCE_CTES}, {_product_table_sql()} SELECT * FROM product_table")
def product_full_load(spark: SparkSession, folder: str) -> DataFrame:
    return full_load(product_sources(spark, folder))


_CHANGED = (
    "changed AS (SELECT p.* FROM products p LEFT JOIN models m ON m.id = p.product_model_id WHERE "
    + " OR ".join(
        f"{c} >= DATE '{AS_OF}' - INTERVAL 4 DAY" for c in ("p.updated", "m.updated", "p.created", "m.created")
    )
    + ")"
)


@query(f"WITH {given.PRODUCT_CTES}, {_CHANGED} SELECT * FROM changed")
def changed_product_scan(spark: SparkSession, folder: str) -> DataFrame:
    return changed_products(product_sources(spark, folder), AS_OF)


_OLD_TARGET = {
    "identifier": "'sku' || p_partkey",
    "title": "'old ' || p_name",
    "enablement": "CAST(-9 AS INT)",
    "manufacturer_gfgh_data": "'|old|'",
}
_DELTA_COLUMNS = "identifier, title, brand, base_code, net_content_uom, manufacturer, category_l1, enablement"


@query(
    f"WITH {_SOURCE_CTES}, {_CHANGED}, {_product_table_sql('changed', False)}, "
    f"target AS ({derive_sql('part', _OLD_TARGET)}) "
    "SELECT identifier, title, NULL AS brand, NULL AS base_code, NULL AS net_content_uom, NULL AS manufacturer, "
    "NULL AS category_l1, enablement, manufacturer_gfgh_data FROM target "
    "WHERE identifier NOT IN (SELECT identifier FROM changed) "
    f"UNION ALL SELECT {_DELTA_COLUMNS}, NULL FROM product_table"
)
def product_delta_load(spark: SparkSession, folder: str) -> DataFrame:
    target = derive(table(spark, folder, "part"), _OLD_TARGET)
    loaded = delta_load(target, product_sources(spark, folder), AS_OF)
    return loaded.select(*_DELTA_COLUMNS.split(", "), "manufacturer_gfgh_data")


# --- jobs that write ---------------------------------------------------------------


def _run_job(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The product job over a target of its own: a full load, then a daily one."""
    name, root = f"products_{uuid.uuid4().hex[:12]}", new_folder(spark)
    sources = product_sources(spark, folder)
    modes = [run_products(sources, name, f"{name}_state", root, AS_OF) for _ in range(2)]
    if modes != ["full", "delta"]:
        raise RuntimeError(f"the job ran as {modes}")
    return name, f"{name}_state"


@query(
    f"WITH {_SOURCE_CTES}, {_CHANGED}, {_product_table_sql()} SELECT {_DELTA_COLUMNS}, "
    "CASE WHEN identifier NOT IN (SELECT identifier FROM changed) THEN manufacturer_gfgh_data END "
    "AS manufacturer_gfgh_data FROM product_table"
)
def product_job(spark: SparkSession, folder: str) -> DataFrame:
    """The stored product table after a full and a daily run."""
    name, _ = _run_job(spark, folder)
    return read_stored(spark, name).select(*_DELTA_COLUMNS.split(", "), "manufacturer_gfgh_data")


@query(
    f"WITH keys AS ({derive_sql('part', given.MERCHANTS_NEW)} UNION {derive_sql('part', given.MERCHANTS_ACTIVE)}) "
    "SELECT count(*) AS merchant_count FROM keys WHERE merchant_key IS NULL "
    "OR merchant_key NOT IN ('trinkkontor', 'trinkkontor_trr')"
)
def population_state(spark: SparkSession, folder: str) -> DataFrame:
    """The number of merchants that the job stored."""
    _, state = _run_job(spark, folder)
    return read_stored(spark, state)
