"""Queries on incremental loading and merging."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from skuweave.operators.merge import append, concat
from skuweave.operators.observe import counted
from skuweave.operators.scans import changed_rows, date_window, look_back
from skuweave.plans.table_sync import (
    FULL_RELOAD,
    INSERT_NEW_ROWS,
    INSERT_NEW_ROWS_DROP_OLD_TABLE,
    UPSERT,
    Sync,
    sync_table,
)
from skuweave.session import new_folder
from skuweave.sinks.tables import append_table, create_table_as, replace_table, upsert_partitions, with_json_text
from skuweave.sources.tables import read_stored
from skuweave.workloads.inputs import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


EVENTS_AS_OF = "2024-01-15"
ORDERS_AS_OF = "2001-07-25"
_WINDOW = "{c} >= DATE '{d}' - INTERVAL 2 DAY AND {c} < DATE '{d}' + INTERVAL 1 DAY"


@query(f"SELECT * FROM events WHERE {_WINDOW.format(c='ts', d=EVENTS_AS_OF)}")
def window_scan(spark: SparkSession, folder: str) -> DataFrame:
    return date_window(table(spark, folder, "events"), "ts", EVENTS_AS_OF)


# DuckDB counts Sunday as day 0.
_LOOK_BACK = "{c} >= DATE '{d}' - CAST(dayofweek(DATE '{d}') + 1 + {n} AS INT)"


@query(f"SELECT * FROM orders WHERE {_LOOK_BACK.format(c='o_orderdate', d=ORDERS_AS_OF, n=30)}")
def lookback_scan(spark: SparkSession, folder: str) -> DataFrame:
    return look_back(table(spark, folder, "orders"), "o_orderdate", ORDERS_AS_OF, 30)


@query(
    "SELECT l.* FROM lineitem l LEFT JOIN orders o ON o_orderkey = l_orderkey "
    f"WHERE l_shipdate >= DATE '{ORDERS_AS_OF}' - INTERVAL 4 DAY OR o_orderdate >= DATE '{ORDERS_AS_OF}' - INTERVAL 4 DAY"
)
def changed_rows_scan(spark: SparkSession, folder: str) -> DataFrame:
    return changed_rows(
        table(spark, folder, "lineitem"), table(spark, folder, "orders"), "l_orderkey", "o_orderkey",
        ("l_shipdate",), ("o_orderdate",), ORDERS_AS_OF,
    )


_ORDERS = "o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice, o_orderdate, o_orderpriority"
_STAMP = "2001-07-25 06:00:00"
_NEW = (
    f"new AS (SELECT {_ORDERS.format(price='o_totalprice + 1')} FROM orders "
    f"WHERE {_WINDOW.format(c='o_orderdate', d=ORDERS_AS_OF)})"
)


def _changed_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumn("o_totalprice", F.col("o_totalprice") + 1)


def _orders_target(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumn("_updated_at", F.lit("2001-01-01 00:00:00").cast("timestamp"))


def _synced(spark: SparkSession, folder: str, mode: str, **settings) -> DataFrame:
    return sync_table(
        _changed_source(spark, folder),
        _orders_target(spark, folder),
        Sync(mode, key="o_orderkey", stamp="o_orderdate", **settings),
        ORDERS_AS_OF,
        F.lit(_STAMP).cast("timestamp"),
    )


_TARGET = "SELECT *, TIMESTAMP '2001-01-01 00:00:00' AS _updated_at FROM orders"


@query(
    f"WITH {_NEW} {_TARGET} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) "
    f"UNION ALL SELECT *, TIMESTAMP '{_STAMP}' FROM new"
)
def upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _synced(spark, folder, UPSERT)


@query(f"WITH {_NEW} {_TARGET} UNION ALL SELECT *, TIMESTAMP '{_STAMP}' FROM new")
def insert_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _synced(spark, folder, INSERT_NEW_ROWS)


@query(
    f"SELECT {_ORDERS.format(price='o_totalprice + 1')}, TIMESTAMP '{_STAMP}' AS _updated_at FROM orders "
    f"WHERE {_LOOK_BACK.format(c='o_orderdate', d=ORDERS_AS_OF, n=22)}"
)
def replace_recent_slice(spark: SparkSession, folder: str) -> DataFrame:
    return _synced(spark, folder, INSERT_NEW_ROWS_DROP_OLD_TABLE, look_back_days=22)


@query(f"SELECT {_ORDERS.format(price='o_totalprice + 1')}, TIMESTAMP '{_STAMP}' AS _updated_at FROM orders")
def full_reload(spark: SparkSession, folder: str) -> DataFrame:
    return _synced(spark, folder, FULL_RELOAD)


@query("SELECT event_id, ts, json(props)::VARCHAR AS data FROM events")
def json_typed_columns(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", F.col("props").alias("data"))
    return with_json_text(events)


@query(
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier "
    "UNION ALL SELECT p_partkey, p_name, p_retailprice, p_type FROM part"
)
def concat_frames(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_acctbal AS balance", "s_name AS name", "s_suppkey AS id"
    )
    parts = table(spark, folder, "part").selectExpr(
        "p_partkey AS id", "p_name AS name", "p_retailprice AS balance", "p_type AS segment"
    )
    return concat([customers, suppliers, parts])


@query(
    "SELECT event_id, user_id, event_type, value FROM events UNION ALL "
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'purchase'"
)
def append_batch(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return append(events, events.where("event_type = 'purchase'"))


_MOVED = "CASE WHEN value > 80 THEN 'moved' ELSE event_type END AS event_type"
_CHANGED_EVENTS = f"SELECT event_id, ts, user_id, value + 1000 AS value, {_MOVED} FROM events WHERE value > 60"


@query(
    "SELECT event_id, ts, user_id, value, event_type FROM events WHERE event_id NOT IN "
    f"(SELECT event_id FROM ({_CHANGED_EVENTS})) UNION ALL {_CHANGED_EVENTS}"
)
def upsert_partition_files(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned folder after a batch, some of whose keys change partition."""
    path = new_folder(spark)
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "value", "event_type")
    events.write.partitionBy("event_type").parquet(path)
    batch = events.where("value > 60").selectExpr("event_id", "ts", "user_id", "value + 1000 AS value", _MOVED)
    upsert_partitions(batch, path, "event_id", "event_type")
    return spark.read.parquet(path)


# --- tables of the catalog, written and read back ----------------------------------


def _name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex[:12]}"


@query("SELECT p_partkey, p_name, p_size + 1 AS p_size FROM part")
def replace_table_files(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table replaced by a query on itself, then read through the catalog."""
    name, root = _name("replaced"), new_folder(spark)
    replace_table(table(spark, folder, "part").select("p_partkey", "p_name", "p_size"), name, root)
    replace_table(spark.table(name).withColumn("p_size", F.col("p_size") + 1), name, root)
    return read_stored(spark, name)


@query(
    "SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"
)
def append_table_files(spark: SparkSession, folder: str) -> DataFrame:
    """A table after an append that brings a column it did not have."""
    name = _name("appended")
    first = table(spark, folder, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    replace_table(first, name, new_folder(spark))
    append_table(table(spark, folder, "supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS id", "s_name AS name"), name)
    return read_stored(spark, name)


@query("SELECT l_returnflag, count(*) AS n, max(l_quantity) AS most FROM lineitem GROUP BY l_returnflag")
def create_table_files(spark: SparkSession, folder: str) -> DataFrame:
    """A table made by a query, over one of the same name, with its logged row count."""
    name = _name("created")
    lines = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("most")
    )
    create_table_as(spark, name, lines.limit(0))
    rows, logged = counted(lines)
    create_table_as(spark, name, rows)
    stored = read_stored(spark, name)
    if logged.get["rows"] != stored.count():
        raise RuntimeError("the logged row count is not that of the table")
    return stored
