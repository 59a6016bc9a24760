from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skuweave.functions.dates import epoch_millis
from skuweave.operators.scans import changed_rows, closed_window, date_window, look_back

STAMPS = [
    ("before", "2024-05-12 23:59:59"),
    ("first", "2024-05-13 00:00:00"),
    ("today", "2024-05-15 12:00:00"),
    ("midnight", "2024-05-15 00:00:00"),
    ("last", "2024-05-15 23:59:59"),
    ("tomorrow", "2024-05-16 00:00:00"),
    ("never", None),
]


def stamps(spark, kind: str):
    df = spark.createDataFrame(STAMPS, "id string, ts string")
    return df.withColumn("ts", F.col("ts").cast(kind))


def ids(df) -> set:
    return {r["id"] for r in df.collect()}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("as_of", ["2024-05-15", dt.date(2024, 5, 15)])
def test_window_edges(spark, kind, as_of):
    df = stamps(spark, kind)
    assert ids(date_window(df, "ts", as_of)) == {"first", "today", "midnight", "last"}
    assert ids(closed_window(df, "ts", as_of)) == {"first", "midnight"}


@pytest.mark.parametrize(
    "as_of, start",
    [
        ("2024-05-12", "2024-05-11"),  # Sunday counts as day 1
        ("2024-05-18", "2024-05-11"),  # Saturday counts as day 7
        ("2024-05-15", "2024-05-11"),
    ],
)
def test_look_back_is_aligned_to_the_week(spark, as_of, start):
    first = dt.datetime.fromisoformat(start) - dt.timedelta(days=30)
    df = spark.createDataFrame(
        [("in", first), ("out", first - dt.timedelta(seconds=1)), ("never", None)], "id string, ts timestamp"
    )
    assert ids(look_back(df, "ts", as_of, 30)) == {"in"}


def test_changed_rows(spark):
    new, old = dt.datetime(2024, 5, 14), dt.datetime(2024, 1, 1)
    parents = spark.createDataFrame(
        [(1, new, old), (2, old, old), (3, None, new)], "id long, updated timestamp, created timestamp"
    )
    rows = spark.createDataFrame(
        [
            ("own", 2, new, old),
            ("created", None, None, new),
            ("parent", 1, old, old),
            ("parent created", 3, old, old),
            ("unchanged", 2, old, old),
            ("no parent", None, old, None),
            ("unknown parent", 9, old, old),
        ],
        "id string, model long, updated timestamp, created timestamp",
    )
    found = changed_rows(rows, parents, "model", "id", as_of="2024-05-15")
    assert found.columns == rows.columns
    assert ids(found) == {"own", "created", "parent", "parent created"}


def test_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    stamps(spark, "timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path)
    for scan in (date_window(df, "ts", "2024-05-15"), look_back(df, "ts", "2024-05-15", 30)):
        plan = scan._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(ts," in plan


def test_epoch_millis_is_midnight_utc(spark):
    df = spark.createDataFrame([(dt.date(1970, 1, 2),), (None,), (dt.date(2024, 5, 15),)], "d date")
    values = [r[0] for r in df.select(epoch_millis(F.col("d"))).collect()]
    assert values == [86_400_000, None, 1_715_731_200_000]
