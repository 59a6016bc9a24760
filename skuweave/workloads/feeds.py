"""Queries on feed cleaning and pivoting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from skuweave.operators.cleaning import clean_sheet, drop_header_rows, picture_uploads
from skuweave.operators.columns import columns_first, drop_columns, lower_case_columns, rename, rename_all
from skuweave.operators.merge import stamped
from skuweave.operators.pivot import pivot_items, pivot_rows, titles_of
from skuweave.plans.feeds import board, run_addresses, sheet
from skuweave.plans.store import store
from skuweave.session import new_folder
from skuweave.sources.files import (
    address_result_columns,
    list_objects,
    read_address_results,
    read_csv,
)
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


_ROLES = ("system", "user", "assistant")


@query(
    "SELECT conv_id, "
    + ", ".join(f'min_by(text, turn) FILTER (role = \'{r}\') AS "{r}"' for r in _ROLES)
    + " FROM conversations GROUP BY conv_id"
)
def eav_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_rows(table(spark, folder, "conversations"), ["conv_id"], "role", "text", _ROLES, "turn")


_ITEM = (
    ("Brand", "p_brand"),
    ("Type", "CASE WHEN p_size % 4 <> 0 THEN p_type END"),
    ("Size", "CAST(p_size AS VARCHAR(10))"),
)


@query(
    'SELECT p_name AS name, p_brand AS "Brand", CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS "Size", '
    'CASE WHEN p_size % 4 <> 0 THEN p_type END AS "Type" FROM part'
)
def board_items(spark: SparkSession, folder: str) -> DataFrame:
    entries = [
        F.struct(F.lit(title).alias("title"), F.expr(text).alias("text")) for title, text in _ITEM
    ]
    items = table(spark, folder, "part").select(
        F.col("p_name").alias("name"),
        F.when(F.expr("p_size % 3 = 0"), F.array(*entries[:2])).otherwise(F.array(*entries)).alias("column_values"),
    )
    return pivot_items(items, titles_of(items))


_SHEET = {
    "c_custkey": "CASE WHEN c_nationkey <> 3 THEN c_custkey END",
    "`Unnamed: 1`": "c_acctbal",
    "c_name": "CASE WHEN c_nationkey <> 3 AND c_nationkey <> 5 THEN c_name END",
    "`unnamed: 3`": "c_name",
}


@query(
    f"SELECT c_custkey, c_name FROM (SELECT {_SHEET['c_custkey']} AS c_custkey, {_SHEET['c_name']} AS c_name "
    "FROM customer) WHERE c_custkey IS NOT NULL OR c_name IS NOT NULL"
)
def clean_worksheet(spark: SparkSession, folder: str) -> DataFrame:
    return clean_sheet(derive(table(spark, folder, "customer"), _SHEET))


@query(
    f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM (SELECT {_SHEET['c_custkey']} AS c_custkey, "
    f"{_SHEET['c_name']} AS c_name FROM customer) WHERE c_custkey IS NOT NULL OR c_name IS NOT NULL"
)
def worksheet_file(spark: SparkSession, folder: str) -> DataFrame:
    """The sheet written as a file whose second and fourth columns have no header."""
    path = new_folder(spark)
    rows = derive(table(spark, folder, "customer"), _SHEET)
    rows.toDF("c_custkey", " ", "c_name", "  ").write.csv(path, header=True)
    return sheet(spark, path)


_ADDRESS = (
    "c_custkey", "c_custkey + 1", "o_orderkey", "c_name", "c_mktsegment", "o_orderpriority", "c_nationkey",
    "o_orderstatus", "o_custkey", "'tel ' || o_orderkey", "c_name || '@example.org'", "CAST(o_orderdate AS DATE)",
)
_ADDRESS_COLUMNS = address_result_columns("sender", "vendor")


@query(
    "SELECT "
    + ", ".join(f"CAST({e} AS VARCHAR) AS {n}" for e, n in zip(_ADDRESS, _ADDRESS_COLUMNS))
    + ", '2024-01-01' AS _updated_at FROM customer JOIN orders ON o_custkey = c_custkey"
)
def address_result_files(spark: SparkSession, folder: str) -> DataFrame:
    """Tab-separated files that all repeat the header, read back as one frame."""
    path = new_folder(spark)
    joined = table(spark, folder, "customer").join(
        table(spark, folder, "orders"), F.col("o_custkey") == F.col("c_custkey")
    )
    upper = [c.upper() for c in _ADDRESS_COLUMNS]
    joined.selectExpr(*_ADDRESS).toDF(*upper).write.csv(path, sep="\t", header=True)
    named = lower_case_columns(read_address_results(spark, path, upper, "part-*"))
    return stamped(drop_header_rows(named, named.columns[0]), F.lit("2024-01-01"))


@query(
    "SELECT "
    + ", ".join(f"CAST({e} AS VARCHAR) AS {n}" for e, n in zip(_ADDRESS, _ADDRESS_COLUMNS))
    + " FROM customer JOIN orders ON o_custkey = c_custkey"
)
def stored_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """Result files that all repeat the header, loaded into a stored table twice."""
    path, name = new_folder(spark), f"addresses_{uuid.uuid4().hex[:12]}"
    joined = table(spark, folder, "customer").join(
        table(spark, folder, "orders"), F.col("o_custkey") == F.col("c_custkey")
    )
    upper = [c.upper() for c in _ADDRESS_COLUMNS]
    joined.selectExpr(*_ADDRESS).toDF(*upper).write.csv(path, sep="\t", header=True)
    root = new_folder(spark)
    for _ in range(2):
        run_addresses(spark, path, upper, name, root, pattern="part-*")
    return read_stored(spark, name).select(*_ADDRESS_COLUMNS)


_FEED = {
    "S_NAME": "CASE WHEN s_nationkey = 4 THEN 'S_NAME' WHEN s_nationkey <> 6 THEN s_name END",
    "S_KEY": "s_suppkey",
    "S_BALANCE": "s_acctbal",
}


@query(
    f"SELECT * FROM (SELECT {_FEED['S_NAME']} AS s_name, s_suppkey AS s_key, s_acctbal AS s_balance FROM supplier) "
    "WHERE s_name IS NULL OR s_name <> 'S_NAME'"
)
def drop_repeated_headers(spark: SparkSession, folder: str) -> DataFrame:
    return drop_header_rows(lower_case_columns(derive(table(spark, folder, "supplier"), _FEED)), "s_name")


_LISTING = {
    "path": "'bucket/' || p_brand || '/' || p_partkey || '/' || CASE WHEN p_size % 5 = 0 THEN 'a' ELSE '' END || p_retailprice_key "
    "|| CASE WHEN p_size % 7 = 0 THEN '.jpg' WHEN p_size % 7 = 1 THEN '.png.png' ELSE '.png' END",
    "modificationTime": "TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' DAY * p_size",
}
_LISTED = "(SELECT *, CAST(p_partkey % 700 AS VARCHAR(10)) AS p_retailprice_key FROM part)"


@query(
    f"WITH listing AS ({derive_sql(_LISTED, _LISTING)}), "
    "named AS (SELECT *, regexp_extract(path, '([^/]*)$', 1) AS name FROM listing) "
    "SELECT regexp_extract(name, '^([0-9]+)\\.png', 1) AS sku, max_by(modificationTime, path) AS uploaded_at FROM named "
    "WHERE regexp_matches(name, '^[0-9]+\\.png(.*\\.png)?$') GROUP BY 1"
)
def picture_listing(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").withColumn(
        "p_retailprice_key", F.expr("CAST(p_partkey % 700 AS VARCHAR(10))")
    )
    return picture_uploads(derive(part, _LISTING))


@query(
    "SELECT n_nationkey AS id, n_name AS label, r_regionkey AS region_id, r_name AS region_label "
    "FROM nation JOIN region ON r_regionkey = n_regionkey"
)
def renamed_columns(spark: SparkSession, folder: str) -> DataFrame:
    nation = rename(table(spark, folder, "nation"), {"n_nationkey": "id", "n_name": "label"})
    region = rename_all(table(spark, folder, "region"), ["region_id", "region_label"])
    joined = nation.join(region, F.col("n_regionkey") == F.col("region_id"))
    return columns_first(drop_columns(joined, ["n_regionkey", "not_there"]), ["label"])


# --- files read back ----------------------------------------------------------------


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_with_schema(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark)
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    part.write.csv(path, header=True)
    return read_csv(spark, path, part.schema)


@query("SELECT DISTINCT p_size FROM part")
def object_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Keys out of the paths of listed objects, one folder of objects per key."""
    path = new_folder(spark)
    table(spark, folder, "part").select("p_size", "p_name").write.partitionBy("p_size").text(path)
    key = F.regexp_extract("path", r"p_size=([0-9]+)/", 1).cast("int")
    return list_objects(spark, path, "part-*").select(key.alias("p_size")).distinct()


@query(
    "SELECT n_name || '/' || c_custkey AS name, c_mktsegment AS segment, "
    "CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS number "
    "FROM customer JOIN nation ON n_nationkey = c_nationkey"
)
def stored_board(spark: SparkSession, folder: str) -> DataFrame:
    """Landed board pages, one JSON file per nation, as a stored table."""
    entry = "named_struct('title', '{}', 'text', {})"
    item = (
        "named_struct('name', n_name || '/' || c_custkey, 'column_values', "
        f"array({entry.format('segment', 'c_mktsegment')}, "
        f"{entry.format('number', 'IF(c_custkey % 3 <> 0, CAST(c_custkey AS STRING), NULL)')}))"
    )
    joined = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("n_nationkey") == F.col("c_nationkey")
    )
    pages = joined.groupBy("n_name", F.expr("c_custkey div 1000").alias("page")).agg(
        F.collect_list(F.expr(item)).alias("items")
    )
    boards = F.struct(F.array(F.struct("items")).alias("boards")).alias("data")
    landed, name = new_folder(spark), f"board_{uuid.uuid4().hex[:12]}"
    pages.select(boards).write.option("maxRecordsPerFile", 1).json(landed)
    store(board(spark, landed).drop("_updated_at"), name, new_folder(spark))
    return read_stored(spark, name)
