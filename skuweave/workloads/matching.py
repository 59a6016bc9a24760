"""Queries on name matching: catalogue and inputs are all rows of ``part``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from skuweave.functions.text import edit_ratio, ngrams, one_contains_other, tokens, without_noise
from skuweave.operators.tfidf import (
    first_matches,
    inverse_document_frequency,
    tfidf_match,
    vector_norms,
)
from skuweave.plans.matching import EXCLUDED_TYPE, match_by_edit_ratio, match_by_tfidf, run_matching, tfidf_catalog
from skuweave.session import new_folder
from skuweave.sources.tables import read_stored
from skuweave.workloads.inputs import derive, derive_sql, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


ALL_SKUS = {
    "identifier": "'sku' || p_partkey",
    "title": "p_name",
    "brand": "p_brand",
    "base_code": "CASE WHEN p_partkey % 50 <> 7 THEN p_type END",
    "type_single_unit": f"CASE WHEN p_partkey % 40 = 3 THEN '{EXCLUDED_TYPE}' ELSE p_type END",
    "enablement": "p_partkey % 9",
    "amount_single_unit": "CAST(p_size AS VARCHAR(10))",
    "net_content": "CASE WHEN p_partkey % 60 <> 11 THEN CASE WHEN p_partkey % 4 < 2 THEN p_type ELSE CAST(p_size % 7 AS VARCHAR(10)) END || ',5' END",
    "net_content_liter": "p_type",
    "base_unit_content": "CASE WHEN p_partkey % 3 = 0 THEN '0,' || length(p_type) || ' ' || p_type ELSE p_type END",
    "no_of_base_units": "p_size",
}
INPUTS = {
    "gfgh_id": "p_partkey",
    "name": "p_name || ' ' || replace(p_brand, '#', '') || ', ' || p_size || ' BD' || lower(p_type)",
    "no_of_base_units": "CAST(p_size AS VARCHAR(10))",
    "base_unit_content": "CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) ELSE p_type || ' l' END",
    "structure_packaging_unit": "p_type",
}


def all_skus(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "part"), ALL_SKUS)


def input_names(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "part"), INPUTS)


# --- TF-IDF ----------------------------------------------------------------------

_CATALOG = (
    f"skus AS ({derive_sql('part', ALL_SKUS)}), catalog AS (SELECT identifier AS sku, base_code, "
    "amount_single_unit, net_content, brand || ' ' || title || ' ' || amount_single_unit || 'x' || net_content "
    f"AS sku_title FROM skus WHERE enablement > 0 AND type_single_unit <> '{EXCLUDED_TYPE}' "
    "AND net_content IS NOT NULL AND base_code IS NOT NULL)"
)
_CLEAN = "regexp_replace({c}, '[,-./]|\\sBD', '', 'g')"


def _grams_sql(source: str, name: str) -> str:
    return (
        f"SELECT name, copies, substr(text, i, 3) AS gram, count(*) AS tf FROM (SELECT {name} AS name, "
        f"count(*) AS copies, {_CLEAN.format(c=name)} AS text FROM {source} WHERE {name} IS NOT NULL GROUP BY {name}), "
        "unnest(range(1, length(text) - 1)) AS g(i) GROUP BY name, copies, substr(text, i, 3)"
    )


_FITTED = (
    f"{_CATALOG}, c_tf AS ({_grams_sql('catalog', 'sku_title')}), "
    "idf AS (SELECT gram, CAST(sum(copies) AS BIGINT) AS df, "
    "ln((1 + (SELECT count(*) FROM catalog)) / (1 + sum(copies))) + 1 AS idf FROM c_tf GROUP BY gram), "
    "c_norm AS (SELECT name, sqrt(sum(tf * idf * tf * idf)) AS norm FROM c_tf JOIN idf USING (gram) GROUP BY name)"
)
_MATCHED = (
    f"{_FITTED}, inputs AS ({derive_sql('part', INPUTS)}), q_tf AS ({_grams_sql('inputs', 'name')}), "
    "q_norm AS (SELECT name, sqrt(sum(tf * idf * tf * idf)) AS norm FROM q_tf JOIN idf USING (gram) GROUP BY name), "
    "c_w AS (SELECT t.name, gram, tf * idf / norm AS w FROM c_tf t JOIN idf USING (gram) JOIN c_norm n ON n.name = t.name), "
    "q_w AS (SELECT t.name, gram, tf * idf / norm AS w FROM q_tf t JOIN idf USING (gram) JOIN q_norm n ON n.name = t.name), "
    "scored AS (SELECT q.name AS name_input, c.name AS name_all_skus, round(sum(q.w * c.w), 9) AS score "
    "FROM q_w q JOIN c_w c USING (gram) GROUP BY q.name, c.name), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY name_input ORDER BY score DESC, name_all_skus) AS n "
    "FROM scored WHERE score > 0.5), "
    "matches AS (SELECT name_input, name_all_skus, score FROM ranked WHERE n = 1)"
)


@query(
    f"WITH names AS (SELECT p_partkey, {_CLEAN.format(c='name')} AS text FROM (SELECT p_partkey, "
    f"{INPUTS['name']} AS name FROM part)) SELECT p_partkey, i AS position, substr(text, i, 3) AS gram "
    "FROM names, unnest(range(1, length(text) - 1)) AS g(i)"
)
def name_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "part").selectExpr("p_partkey", f"{INPUTS['name']} AS name")
    text = names.select("p_partkey", without_noise(F.col("name")).alias("text"))
    return text.select("p_partkey", F.posexplode(ngrams(F.col("text"))).alias("position", "gram")).select(
        "p_partkey", (F.col("position") + 1).cast("long").alias("position"), "gram"
    )


@query(f"WITH {_FITTED} SELECT gram, df, round(idf, 9) AS idf FROM idf")
def tfidf_idf(spark: SparkSession, folder: str) -> DataFrame:
    fitted = inverse_document_frequency(tfidf_catalog(all_skus(spark, folder)), "sku_title")
    return fitted.select("gram", "df", F.round("idf", 9).alias("idf"))


@query(f"WITH {_FITTED} SELECT name, round(norm, 6) AS norm FROM c_norm")
def tfidf_norms(spark: SparkSession, folder: str) -> DataFrame:
    norms = vector_norms(tfidf_catalog(all_skus(spark, folder)), "sku_title")
    return norms.select("name", F.round("norm", 6).alias("norm"))


@query(f"WITH {_MATCHED} SELECT name_input, name_all_skus, round(score, 6) AS similarity FROM matches")
def tfidf_name_match(spark: SparkSession, folder: str) -> DataFrame:
    matches = tfidf_match(tfidf_catalog(all_skus(spark, folder)), input_names(spark, folder))
    return matches.withColumn("similarity", F.round("similarity", 6))


@query(
    f"WITH {_MATCHED} SELECT name_input, name_all_skus, round(score, 6) AS similarity FROM ranked "
    "WHERE n <= 3 ORDER BY name_input, score DESC, name_all_skus LIMIT 100"
)
def tfidf_first_matches(spark: SparkSession, folder: str) -> DataFrame:
    matches = tfidf_match(tfidf_catalog(all_skus(spark, folder)), input_names(spark, folder), top=3)
    return first_matches(matches, 100).withColumn("similarity", F.round("similarity", 6))


@query(
    f"WITH {_MATCHED}, joined AS (SELECT c.sku, i.gfgh_id, m.name_input, "
    "CAST(i.no_of_base_units AS INT) AS no_of_base_units_input, i.base_unit_content AS base_unit_content_input, "
    "m.name_all_skus, TRY_CAST(c.amount_single_unit AS INT) AS no_of_base_units_all_skus, "
    "TRY_CAST(replace(c.net_content, ',', '.') AS DOUBLE) AS base_unit_content_all_skus, "
    "round(m.score, 6) AS similarity FROM inputs i JOIN matches m ON m.name_input = i.name "
    "JOIN catalog c ON c.sku_title = m.name_all_skus) "
    "SELECT * FROM joined WHERE no_of_base_units_input = no_of_base_units_all_skus "
    "QUALIFY row_number() OVER (PARTITION BY gfgh_id ORDER BY similarity DESC, sku) = 1"
)
def tfidf_match_products(spark: SparkSession, folder: str) -> DataFrame:
    found = match_by_tfidf(all_skus(spark, folder), input_names(spark, folder), tolerant=True)
    return found.withColumn("similarity", F.round("similarity", 6))


# --- edit ratio ------------------------------------------------------------------


def _lcs_sql(pairs: str) -> str:
    """Recursive statement: one row of the dynamic programme per character of ``a``."""
    return (
        f"lcs AS (SELECT a, b, 0 AS i, list_transform(range(length(b) + 1), lambda x: 0) AS r FROM ({pairs}) "
        "UNION ALL SELECT a, b, i + 1, list_reduce(range(1, length(b) + 1), lambda cur, k: list_append(cur, "
        "CASE WHEN substr(b, k::INT, 1) = substr(a, i + 1, 1) THEN r[k::INT] + 1 "
        "ELSE greatest(r[k::INT + 1], cur[-1]) END), [0]) FROM lcs WHERE i < length(a)), "
        "ratios AS (SELECT a, b, CAST(round_even(200.0 * r[-1] / (length(a) + length(b)), 0) AS INT) AS ratio "
        "FROM lcs WHERE i = length(a))"
    )


def _words_sql(column: str) -> str:
    return (
        f"list_distinct(list_filter(string_split(lower(regexp_replace({column}, '[^A-Za-z0-9_]', ' ', 'g')), ' '), "
        "lambda w: w <> ''))"
    )


def _contains_sql(a: str, b: str) -> str:
    return f"(len({a}) > 0 AND len({b}) > 0 AND (list_has_all({a}, {b}) OR list_has_all({b}, {a})))"


_SKU_NAME = f"{ALL_SKUS['title']} || ' ' || p_brand || ' ' || p_size || 'x' || p_type"


@query(
    "WITH RECURSIVE names AS (SELECT p_partkey, "
    f"{_SKU_NAME} AS a, {INPUTS['name']} AS b FROM part), {_lcs_sql('SELECT DISTINCT a, b FROM names')} "
    "SELECT p_partkey, ratio FROM names JOIN ratios USING (a, b)"
)
def name_edit_ratio(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "part").selectExpr(
        "p_partkey", f"{_SKU_NAME} AS a", f"{INPUTS['name']} AS b"
    )
    return names.select("p_partkey", edit_ratio(F.col("a"), F.col("b")).alias("ratio"))


@query(
    f"WITH units AS (SELECT p_partkey, {_words_sql(ALL_SKUS['base_unit_content'])} AS a, "
    f"{_words_sql(INPUTS['base_unit_content'])} AS b FROM part) "
    f"SELECT p_partkey, len(a) AS words, {_contains_sql('a', 'b')} AS agrees FROM units"
)
def unit_token_sets(spark: SparkSession, folder: str) -> DataFrame:
    units = table(spark, folder, "part").selectExpr(
        "p_partkey", f"{ALL_SKUS['base_unit_content']} AS a", f"{INPUTS['base_unit_content']} AS b"
    )
    words = units.select("p_partkey", tokens(F.col("a")).alias("a"), tokens(F.col("b")).alias("b"))
    return words.select(
        "p_partkey",
        F.size("a").cast("long").alias("words"),
        one_contains_other(F.col("a"), F.col("b")).alias("agrees"),
    )


@query(
    f"WITH RECURSIVE skus AS (SELECT *, title || ' ' || brand || ' ' || amount_single_unit || 'x' || net_content_liter "
    f"AS sku_name FROM ({derive_sql('part', ALL_SKUS)})), inputs AS ({derive_sql('part', INPUTS)}), "
    "c AS (SELECT identifier, sku_name, base_unit_content, CAST(no_of_base_units AS VARCHAR) AS no_of_base_units, "
    f"{_words_sql('base_unit_content')} AS content_words, {_words_sql('CAST(no_of_base_units AS VARCHAR)')} AS units_words FROM skus), "
    f"q AS (SELECT *, {_words_sql('base_unit_content')} AS content_words, {_words_sql('no_of_base_units')} AS units_words FROM inputs), "
    "pairs AS (SELECT c.identifier, c.sku_name, c.base_unit_content AS c_content, c.no_of_base_units AS c_units, "
    "q.gfgh_id, q.name, q.no_of_base_units, q.base_unit_content, q.structure_packaging_unit FROM c JOIN q "
    f"ON {_contains_sql('c.units_words', 'q.units_words')} AND {_contains_sql('c.content_words', 'q.content_words')} "
    "AND 2 * least(length(c.sku_name), length(q.name)) >= 0.695 * (length(c.sku_name) + length(q.name))), "
    f"{_lcs_sql('SELECT DISTINCT sku_name AS a, name AS b FROM pairs')} "
    "SELECT sku_name AS name_all_skus, identifier AS Golden_record, c_content AS base_unit_content_allskus, "
    "c_units AS no_of_base_units_allskus, gfgh_id, name AS name_gfgh, no_of_base_units AS no_of_base_units_gfgh, "
    "base_unit_content AS base_unit_content_gfgh, structure_packaging_unit AS structure_packaging_unit_gfgh, "
    "ratio AS name_similarity, CAST(100 AS INT) AS base_unit_content_similarity, CAST(100 AS INT) AS no_base_units_similarity "
    "FROM pairs JOIN ratios ON a = sku_name AND b = name WHERE ratio >= 70"
)
def fuzzy_name_match(spark: SparkSession, folder: str) -> DataFrame:
    return match_by_edit_ratio(all_skus(spark, folder), input_names(spark, folder))


@query(ORACLES["fuzzy_name_match"])
def stored_edit_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The matching job from the product table to the stored result."""
    name = f"matches_{uuid.uuid4().hex[:12]}"
    run_matching(all_skus(spark, folder), input_names(spark, folder), name, new_folder(spark))
    return read_stored(spark, name)


@query(ORACLES["tfidf_match_products"])
def stored_tfidf_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The same job by cosine, whose result takes the place of an earlier one."""
    name, root = f"matches_{uuid.uuid4().hex[:12]}", new_folder(spark)
    skus, inputs = all_skus(spark, folder), input_names(spark, folder)
    run_matching(skus, inputs, name, root)
    run_matching(skus, inputs, name, root, "tfidf", tolerant=True)
    return read_stored(spark, name).withColumn("similarity", F.round("similarity", 6))
