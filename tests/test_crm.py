from __future__ import annotations

import datetime as dt
import json

from comparing import records
from pyspark.sql import functions as F

from skuweave.operators.crm import PROPERTIES, TABLE_COLUMNS, crm_table, deliver, payload, recently_updated
from skuweave.plans.crm import build_table, recent_payloads
from skuweave.session import together
from skuweave.sinks.text import fixed_format_line, latin_9, write_fixed_format

DAY = dt.date(2024, 5, 15)


def customers(spark, *changes):
    base = {
        "customer_state": "Registered",
        **{c: f"{c}?" for c in TABLE_COLUMNS if c not in ("last_sync",)},
        "parent_customer_owner_email": "a@example.org",
        "parent_customer_owner_creation_date": DAY,
        "child_customer_invitation_date": None,
        "child_customer_first_order_date": DAY,
        "child_customer_last_order_date": None,
        "child_customer_number_of_orders": 3,
        "child_customer_number_of_orders_last_3_months": None,
        "child_customer_average_days_between_orders": 2.5,
        "created_at": dt.datetime(2024, 1, 1),
        "updated_at": dt.datetime(2024, 5, 15),
        "deleted_at": None,
    }
    dates = ("creation_date", "invitation_date", "order_date")

    def kind(name):
        if name.endswith(dates):
            return "date"
        if name.endswith("_at"):
            return "timestamp"
        if "number_of_orders" in name:
            return "long"
        return "double" if "average" in name else "string"

    schema = ", ".join(f"{c} {kind(c)}" for c in base)
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], schema)


def test_states_and_columns(spark):
    df = customers(spark, {}, {"customer_state": "Connected"}, {"customer_state": "Invited"}, {"customer_state": None})
    table = crm_table(df, DAY)
    assert table.columns == list(TABLE_COLUMNS)
    assert [r["last_sync"] for r in records(table)] == [DAY, DAY]


def test_window_has_both_ends(spark):
    times = ["2024-05-12 23:59:59", "2024-05-13 00:00:00", "2024-05-15 00:00:00", "2024-05-15 00:00:01"]
    df = customers(spark, *[{"updated_at": dt.datetime.fromisoformat(t)} for t in times])
    assert {str(r["updated_at"]) for r in records(recently_updated(df, DAY))} == set(times[1:3])


def test_payload(spark):
    df = customers(spark, {"child_customer_name": "NaN", "child_customer_status": None, "child_customer_address_city": 'a "b" ü'})
    row = payload(df).first()
    assert row["email"] == "a@example.org"
    found = json.loads(row["payload"])["properties"]
    assert [p["property"] for p in found] == [p[0] for p in PROPERTIES] + ["datum_der_ersten_bestellung"]
    values = {p["property"]: p["value"] for p in found}
    midnight = 1_715_731_200_000
    assert values["wann_registriert_nutzer"] == values["datum_der_ersten_bestellung"] == midnight
    assert values["betriebsname"] == "" and values["customer_status"] is None
    assert values["ort"] == 'a "b" ü'
    assert values["durchschnittlicher_bestellrhythmus__b_"] == 2.5
    assert values["wie_oft_durchschnittlichen_in_den_letzten_3_monaten_bestellt_betrieb"] == 0


def test_all_optional_properties(spark):
    df = customers(spark, {"child_customer_invitation_date": DAY, "child_customer_last_order_date": DAY})
    assert len(json.loads(payload(df).first()["payload"])["properties"]) == 18


def test_job(spark):
    df = customers(spark, {}, {"updated_at": dt.datetime(2020, 1, 1)}, {"customer_state": "Other"})
    build_table(df, "crm_upload", DAY)
    assert spark.table("crm_upload").count() == 2
    assert recent_payloads(spark.table("crm_upload"), DAY).count() == 1
    spark.sql("DROP TABLE crm_upload")


def test_delivery_runs_per_row(spark, tmp_path):
    df = customers(spark, *[{"parent_customer_owner_email": f"{i}@example.org"} for i in range(5)])
    folder = str(tmp_path)

    def send(email, document):
        with open(f"{folder}/{email}", "w") as file:
            file.write(document)

    deliver(payload(df), send)
    assert sorted(p.name for p in tmp_path.iterdir()) == [f"{i}@example.org" for i in range(5)]
    assert json.loads((tmp_path / "3@example.org").read_text())["properties"][3]["value"] == "3@example.org"


def test_fixed_format_bytes(spark, tmp_path):
    folder = tmp_path / "out"
    df = spark.createDataFrame(
        [("a@b", 'say "x"', "€ ü", 5), (None, "", " 中 ", None)], "a string, b string, c string, n int"
    ).coalesce(1)
    write_fixed_format(df, str(folder))
    data = b"".join(p.read_bytes() for p in sorted(folder.glob("part-*")))
    assert data == b'"a@b"@"say ""x"""@"\xa4 \xfc"@"5"\r\n""@""@" ? "@""\r\n'
    lines = [r["line"] for r in df.select(fixed_format_line(df).alias("line")).collect()]
    assert lines == ['"a@b"@"say ""x"""@"€ ü"@"5"', '""@""@" 中 "@""']


def test_every_character_of_the_charset(spark):
    points = [*range(1, 0x300), 0x152, 0x178, 0x20AC, 0x2122, 0xFFFD, 0x1F600, 0x10FFFF]
    texts = [chr(point) + "x" for point in points if not 0xD800 <= point < 0xE000]
    df = spark.createDataFrame([(text,) for text in texts], "text string").coalesce(1)
    found = [bytes(r[0]) for r in df.select(latin_9(F.col("text"))).collect()]
    assert found == [text.encode("iso8859-15", "replace") for text in texts]


def test_writers_side_by_side(spark, tmp_path):
    """Two writers and a reader in one session do not disturb each other."""
    frames = [spark.range(50).select(F.lit(f"€{n}").alias("a"), "id").coalesce(1) for n in range(4)]
    together(*(lambda n=n, df=df: write_fixed_format(df, str(tmp_path / f"out{n}")) for n, df in enumerate(frames)))
    for n in range(4):
        data = b"".join(p.read_bytes() for p in sorted((tmp_path / f"out{n}").glob("part-*")))
        assert data == b"".join(b'"\xa4%d"@"%d"\r\n' % (n, i) for i in range(50))


def test_epoch_of_text_dates(spark):
    from skuweave.functions.dates import epoch_millis

    df = spark.createDataFrame([("2024-05-15 10:00:00",)], "t string")
    assert df.select(epoch_millis(F.col("t").cast("timestamp"))).first()[0] == 1_715_731_200_000
