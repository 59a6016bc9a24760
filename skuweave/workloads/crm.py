"""Queries on the customer export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skuweave.operators.crm import (
    OPTIONAL_PROPERTIES,
    PROPERTIES,
    TABLE_COLUMNS,
    crm_table,
    payload,
    recently_updated,
)
from skuweave.session import new_folder
from skuweave.sinks.text import fixed_format_line, write_fixed_format
from skuweave.workloads.inputs import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


AS_OF = "2001-07-31"

# Customers with their order history; shared by both sides.
CUSTOMER = {
    "customer_state": "CASE WHEN c_nationkey % 4 = 0 THEN 'Registered' WHEN c_nationkey % 4 = 1 THEN 'Connected' "
    "WHEN c_nationkey % 4 = 2 THEN 'Invited' END",
    "customer_order_state": "CASE WHEN orders > 8 THEN 'active' ELSE 'passive' END",
    "parent_customer_owner_first_name": "substr(c_name, 1, 8)",
    "parent_customer_owner_last_name": "substr(c_name, 10, 9)",
    "parent_customer_owner_email": "'c' || c_custkey || '@example.org'",
    "parent_customer_owner_mobile_phone": "CASE WHEN c_custkey % 3 = 0 THEN '+49 ' || c_custkey END",
    "parent_customer_owner_lead_source": "CASE WHEN c_custkey % 4 = 0 THEN 'NaN' ELSE c_mktsegment END",
    "parent_customer_owner_creation_date": "CAST(first_order AS DATE)",
    "child_customer_uuid": "'uuid-' || c_custkey",
    "child_customer_name": "CASE WHEN c_custkey % 7 = 0 THEN 'NaN' WHEN c_custkey % 7 <> 1 THEN c_name END",
    "child_customer_status": "c_mktsegment",
    "child_customer_invitation_date": "CASE WHEN c_custkey % 2 = 0 THEN CAST(first_order AS DATE) END",
    "child_customer_first_order_date": "CAST(first_order AS DATE)",
    "child_customer_last_order_date": "CAST(last_order AS DATE)",
    "child_customer_number_of_orders": "orders",
    "child_customer_number_of_orders_last_3_months": "CASE WHEN orders > 3 THEN orders - 3 END",
    "child_customer_address_street": "'Weg ' || c_custkey || ' \"' || c_nationkey || '\"'",
    "child_customer_address_zip": "CAST(c_custkey AS VARCHAR(20))",
    "child_customer_address_city": "CASE WHEN c_custkey % 5 = 0 THEN 'NaN' ELSE 'Stadt@' || c_nationkey END",
    "child_customer_average_days_between_orders": "CASE WHEN orders > 1 THEN c_acctbal END",
    "created_at": "first_order",
    "updated_at": "last_order",
    "deleted_at": "CASE WHEN c_custkey % 90 = 1 THEN last_order END",
}
_HISTORY = (
    "SELECT c.*, o.orders, o.first_order, o.last_order FROM customer c LEFT JOIN "
    "(SELECT o_custkey, count(*) AS orders, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order "
    "FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey"
)
_CUSTOMERS = f"customers AS (SELECT {', '.join(f'{e} AS {n}' for n, e in CUSTOMER.items())} FROM ({_HISTORY}))"
_TABLE = (
    f"{_CUSTOMERS}, crm AS (SELECT "
    + ", ".join(f"DATE '{AS_OF}' AS last_sync" if c == "last_sync" else c for c in TABLE_COLUMNS)
    + " FROM customers WHERE customer_state = 'Registered' OR customer_state = 'Connected')"
)
_RECENT = f"recent AS (SELECT * FROM crm WHERE updated_at BETWEEN DATE '{AS_OF}' - INTERVAL 2 DAY AND DATE '{AS_OF}')"


def customer_information(spark: SparkSession, folder: str) -> DataFrame:
    history = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
    )
    joined = table(spark, folder, "customer").join(history, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.selectExpr(*[f"{e} AS {n}" for n, e in CUSTOMER.items()])


@query(f"WITH {_TABLE} SELECT * FROM crm")
def crm_customers(spark: SparkSession, folder: str) -> DataFrame:
    return crm_table(customer_information(spark, folder), AS_OF)


@query(f"WITH {_TABLE}, {_RECENT} SELECT * FROM recent")
def crm_recent(spark: SparkSession, folder: str) -> DataFrame:
    return recently_updated(crm_table(customer_information(spark, folder), AS_OF), AS_OF)


def _value_sql(source: str, kind: str) -> str:
    value = {
        "plain": source,
        "string": source,
        "text": f"CASE WHEN {source} = 'NaN' THEN '' ELSE {source} END",
        "day": f"epoch_ms(CAST({source} AS TIMESTAMP))",
    }[kind]
    if source in ("child_customer_average_days_between_orders", "child_customer_number_of_orders_last_3_months"):
        value = f"coalesce({value}, 0)"
    return f"coalesce(CAST(to_json({value}) AS VARCHAR), 'null')"


def _entry_sql(name: str, source: str, kind: str) -> str:
    return f"""'{{"property":"{name}","value":' || {_value_sql(source, kind)} || '}}'"""


_PAYLOAD = (
    """'{"properties":[' || """
    + " || ',' || ".join(_entry_sql(*p) for p in PROPERTIES)
    + "".join(
        f" || CASE WHEN {source} IS NOT NULL THEN ',' || {_entry_sql(name, source, kind)} ELSE '' END"
        for name, source, kind in OPTIONAL_PROPERTIES
    )
    + " || ']}'"
)


@query(f"WITH {_TABLE} SELECT parent_customer_owner_email AS email, {_PAYLOAD} AS payload FROM crm")
def crm_payloads(spark: SparkSession, folder: str) -> DataFrame:
    return payload(crm_table(customer_information(spark, folder), AS_OF))


_EXPORT = (
    "child_customer_uuid", "child_customer_name", "child_customer_address_street",
    "child_customer_address_zip", "child_customer_address_city", "child_customer_number_of_orders",
)


_LINE = " || '@' || ".join(
    f"""'"' || replace(coalesce(CAST({c} AS VARCHAR), ''), '"', '""') || '"'""" for c in _EXPORT
)


@query(f"WITH {_TABLE} SELECT {_LINE} AS line FROM crm")
def fixed_format_file(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the written files."""
    path = new_folder(spark)
    write_fixed_format(crm_table(customer_information(spark, folder), AS_OF).select(*_EXPORT), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(f"WITH {_TABLE} SELECT child_customer_uuid AS id, {_LINE} AS line FROM crm")
def fixed_format_lines(spark: SparkSession, folder: str) -> DataFrame:
    export = crm_table(customer_information(spark, folder), AS_OF).select(*_EXPORT)
    return export.select(F.col("child_customer_uuid").alias("id"), fixed_format_line(export).alias("line"))
