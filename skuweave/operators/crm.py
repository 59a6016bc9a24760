"""Customer export for a contact system."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from skuweave.functions.dates import AsOf, day, epoch_millis
from skuweave.operators.scans import closed_window

# The exported states and columns.
EXPORTED_STATES = ("Registered", "Connected")
TABLE_COLUMNS = (
    "customer_order_state",
    "parent_customer_owner_first_name",
    "parent_customer_owner_last_name",
    "parent_customer_owner_email",
    "parent_customer_owner_mobile_phone",
    "parent_customer_owner_lead_source",
    "parent_customer_owner_creation_date",
    "child_customer_uuid",
    "child_customer_name",
    "child_customer_status",
    "child_customer_invitation_date",
    "child_customer_first_order_date",
    "child_customer_last_order_date",
    "child_customer_number_of_orders",
    "child_customer_number_of_orders_last_3_months",
    "child_customer_address_street",
    "child_customer_address_zip",
    "child_customer_address_city",
    "child_customer_average_days_between_orders",
    "created_at",
    "updated_at",
    "last_sync",
    "deleted_at",
)

# The text that stands for a missing value, and the measures filled with 0.
MISSING_TEXT = "NaN"
FILLED_MEASURES = (
    "child_customer_average_days_between_orders",
    "child_customer_number_of_orders_last_3_months",
)

# Property name, source column and how the value is written, in
# payload order. "text" blanks the missing text, "day" is epoch milliseconds.
PROPERTIES = (
    ("bestellaktivitat", "customer_order_state", "plain"),
    ("vorname_nutzer", "parent_customer_owner_first_name", "plain"),
    ("nachname_nutzer", "parent_customer_owner_last_name", "plain"),
    ("email", "parent_customer_owner_email", "plain"),
    ("lead_source", "parent_customer_owner_lead_source", "text"),
    ("wann_registriert_nutzer", "parent_customer_owner_creation_date", "day"),
    ("Customer_UUID", "child_customer_uuid", "string"),
    ("betriebsname", "child_customer_name", "text"),
    ("customer_status", "child_customer_status", "text"),
    ("stra_e", "child_customer_address_street", "text"),
    ("ort", "child_customer_address_city", "text"),
    ("durchschnittlicher_bestellrhythmus__b_", "child_customer_average_days_between_orders", "plain"),
    (
        "wie_oft_durchschnittlichen_in_den_letzten_3_monaten_bestellt_betrieb",
        "child_customer_number_of_orders_last_3_months",
        "plain",
    ),
    ("PLZ", "child_customer_address_zip", "plain"),
    ("Telefonnummer", "parent_customer_owner_mobile_phone", "plain"),
)
# Only written where the date is present.
OPTIONAL_PROPERTIES = (
    ("letzte_bestellung", "child_customer_last_order_date", "day"),
    ("datum_der_ersten_bestellung", "child_customer_first_order_date", "day"),
    ("datum_einladung", "child_customer_invitation_date", "day"),
)


def crm_table(customers: DataFrame, as_of: AsOf = None, state: str = "customer_state") -> DataFrame:
    """The exported columns of registered and connected customers."""
    return (
        customers.where(F.col(state).isin(*EXPORTED_STATES))
        .withColumn("last_sync", day(as_of))
        .select(*TABLE_COLUMNS)
    )


def recently_updated(table: DataFrame, as_of: AsOf = None, stamp: str = "updated_at") -> DataFrame:
    return closed_window(table, stamp, as_of, days_back=2)


def fill_measures(df: DataFrame) -> DataFrame:
    return df.fillna(0, subset=[c for c in FILLED_MEASURES if c in df.columns])


def blank_missing(column: Column) -> Column:
    """The missing text becomes empty; a null stays null."""
    return F.when(column == MISSING_TEXT, F.lit("")).otherwise(column)


def _property(name: str, source: str, kind: str) -> Column:
    column = F.col(source)
    value = {
        "plain": lambda: column,
        "text": lambda: blank_missing(column),
        "day": lambda: epoch_millis(column),
        "string": lambda: column.cast("string"),
    }[kind]()
    return F.struct(F.lit(name).alias("property"), value.cast("variant").alias("value"))


def payload(df: DataFrame, email: str = "parent_customer_owner_email") -> DataFrame:
    """``(email, payload)``: the properties as one JSON document per customer.

    Values keep their JSON type and nulls are written, except for the optional
    dates, which are left out when absent.
    """
    filled = fill_measures(df)
    fixed = F.array(*[_property(*p) for p in PROPERTIES])
    optional = F.filter(
        F.array(*[_property(*p) for p in OPTIONAL_PROPERTIES]), lambda p: p["value"].isNotNull()
    )
    document = F.struct(F.concat(fixed, optional).alias("properties"))
    return filled.select(
        F.col(email).alias("email"),
        F.to_json(document, {"ignoreNullFields": "false"}).alias("payload"),
    )


def deliver(payloads: DataFrame, send: Callable[[str, str], None]) -> None:
    """Hand every ``(email, payload)`` to ``send`` on the executors.

    A task that is retried sends its rows again; the receiver keys them by email.
    """

    def send_rows(rows):
        for row in rows:
            send(row["email"], row["payload"])

    payloads.select("email", "payload").foreachPartition(send_rows)
