"""Customer table for the contact system and the payloads of recent changes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skuweave.functions.dates import AsOf
from skuweave.operators.crm import crm_table, payload, recently_updated
from skuweave.sinks.tables import create_table_as


def build_table(customers: DataFrame, table: str, as_of: AsOf = None) -> None:
    create_table_as(customers.sparkSession, table, crm_table(customers, as_of))


def recent_payloads(table: DataFrame, as_of: AsOf = None) -> DataFrame:
    return payload(recently_updated(table, as_of))
