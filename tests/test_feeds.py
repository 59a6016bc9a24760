from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from comparing import by_key, records

from skuweave.operators.cleaning import clean_sheet, picture_uploads
from skuweave.operators.columns import columns_first, drop_columns_like, restrict_and_enrich
from skuweave.operators.dedup import keep_one, max_per_key
from skuweave.operators.pivot import pivot_rows, titles_of
from skuweave.plans import feeds
from skuweave.sources.files import address_result_columns, read_csv
from skuweave.sources.tables import Database, query_options, read_stored, table_options


def test_sheet(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text('name,,note,unnamed x\na,1,"two\nlines",9\n,5,,8\nb,,"say ""hi""",7\n')
    df = feeds.sheet(spark, str(path))
    assert df.columns == ["name", "note"]
    assert sorted(map(tuple, df.collect())) == [("a", "two\nlines"), ("b", 'say "hi"')]


def test_clean_sheet_keeps_partly_empty_rows(spark):
    df = spark.createDataFrame([("a", None, "x"), (None, None, "x")], "a string, b string, `Unnamed: 2` string")
    assert records(clean_sheet(df)) == [{"a": "a", "b": None}]


def test_address_results(spark, tmp_path):
    columns = address_result_columns("OWNER", "VENDOR")
    assert len(columns) == 12 and columns[0] == "OWNER_id" and columns[-1] == "expdate"
    line = "\t".join(str(i) for i in range(12))
    header = "\t".join(c.upper() for c in columns)
    (tmp_path / "Kunden_result_1.txt").write_text(f"{header}\n{line}\n")
    (tmp_path / "Kunden_result_2.txt").write_text(f"{line}\n{header}\n{line}\n")
    (tmp_path / "Kunden_other.txt").write_text(f"{line}\n")
    df = feeds.address_results(spark, str(tmp_path), columns)
    assert df.columns == [c.lower() for c in columns]
    assert df.count() == 3
    assert df.where("owner_id = '0' and expdate = '11'").count() == 3


def test_feeds_are_stored(spark, tmp_path):
    """Result files by the default pattern and listed pictures replace their tables."""
    columns = address_result_columns("OWNER", "VENDOR")
    landed, root = tmp_path / "landed", str(tmp_path / "tables")
    landed.mkdir()
    line = "\t".join(str(i) for i in range(12))
    for n in (1, 2):
        (landed / f"Kunden_result_{n}.txt").write_text(f"{line}\n")
        assert feeds.run_addresses(spark, str(landed), columns, "addresses_fed", root) == n
    rows = records(spark.table("addresses_fed"))
    assert len(rows) == 2 and all(r["owner_id"] == "0" and r["_updated_at"] for r in rows)
    (landed / "77.png").write_bytes(b"x")
    assert feeds.run_pictures(spark, str(landed), "pictures_fed", root) == 1
    assert [r["sku"] for r in records(spark.table("pictures_fed"))] == ["77"]
    for name in ("addresses_fed", "pictures_fed"):
        spark.sql(f"DROP TABLE {name}")


def page(*items):
    return {
        "data": {"boards": [{"items": [
            {"name": n, "column_values": [{"title": t, "text": x} for t, x in values.items()]}
            for n, values in items
        ]}]}
    }


def test_board(spark, tmp_path):
    (tmp_path / "1.json").write_text(
        json.dumps(page(("twin", {"A": "1", "B": None}), ("twin", {"A": "2", "C": "3"})))
    )
    (tmp_path / "2.json").write_text(json.dumps(page(("last", {"B": "4"}))))
    df = feeds.board(spark, str(tmp_path))
    assert df.columns == ["name", "A", "B", "C", "_updated_at"]
    rows = sorted((r["name"], r["A"], r["B"], r["C"]) for r in records(df.fillna("-")))
    assert rows == [("last", "-", "4", "-"), ("twin", "1", "-", "-"), ("twin", "2", "-", "3")]


def test_too_many_titles(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps(page(("x", {"A": "1", "B": "2"}))))
    items = feeds.explode_items(feeds.read_board_pages(spark, str(tmp_path)))
    with pytest.raises(ValueError):
        titles_of(items, limit=1)


def test_pivot_of_rows_takes_the_first(spark):
    df = spark.createDataFrame(
        [(1, 2, "a", "late"), (1, 1, "a", "early"), (1, 3, "b", "x"), (2, 1, "c", "ignored")],
        "id long, n long, title string, text string",
    )
    rows = by_key(pivot_rows(df, ["id"], "title", "text", ["a", "b"], "n"), "id")
    assert rows[1] == {"id": 1, "a": "early", "b": "x"}
    assert rows[2] == {"id": 2, "a": None, "b": None}


def test_pictures(spark, tmp_path):
    for folder, name in [("a", "123.png"), ("b", "123.png"), ("a", "12a.png"), ("a", "123.jpg"), ("a", "7.png.png")]:
        path = tmp_path / folder / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"x")
        os.utime(path, (1_700_000_000, 1_700_000_000 + (folder == "b")))
    rows = by_key(feeds.pictures(spark, str(tmp_path)), "sku")
    assert set(rows) == {"123", "7"}
    assert rows["123"]["uploaded_at"].timestamp() == 1_700_000_001


def test_last_path_wins_even_if_older(spark):
    df = spark.createDataFrame(
        [("x/z/5.png", dt.datetime(2020, 1, 1)), ("x/a/5.png", dt.datetime(2024, 1, 1))],
        "path string, modificationTime timestamp",
    )
    assert records(picture_uploads(df)) == [{"sku": "5", "uploaded_at": dt.datetime(2020, 1, 1)}]


def test_enriching_keeps_own_columns(spark):
    df = spark.createDataFrame([("a", "mine", "kept")], "id string, title string, odd_y string")
    facts = spark.createDataFrame([("a", "theirs", "c1"), ("b", "x", "y")], "sku string, Title string, cat string")
    joined = restrict_and_enrich(df, facts, "id", "sku")
    assert records(joined) == [{"id": "a", "title": "mine", "odd_y": "kept", "sku": "a", "cat": "c1"}]


def test_column_lists(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, unNAMED int, c int")
    assert drop_columns_like(df, "Unnamed").columns == ["a.b", "c"]
    assert columns_first(df, ["c"]).columns == ["c", "a.b", "unNAMED"]


def test_keep_one_and_maximum(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "w"), (None, 3, "n"), ("b", 1, "y")], "k string, n long, v string")
    assert by_key(keep_one(df, ["k"]), "k")["a"]["n"] == 1
    assert by_key(keep_one(df, ["k"], ["v"]), "k")["a"]["n"] == 2
    assert by_key(max_per_key(df, "k"), "k") == {
        "a": {"k": "a", "n": 2, "v": "x"}, "b": {"k": "b", "n": 1, "v": "y"},
    }
    plan = keep_one(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_stored_tables_and_csv(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert read_stored(spark, path).count() == 3
    spark.range(2).createOrReplaceTempView("two")
    assert read_stored(spark, "two").count() == 2
    (tmp_path / "in.csv").write_text("gfgh_id,name\n1,a\n")
    assert records(read_csv(spark, str(tmp_path / "in.csv"), "gfgh_id long, name string")) == [{"gfgh_id": 1, "name": "a"}]


def test_database_options():
    db = Database("jdbc:x:y", {"user": "u"})
    split = table_options(db, "s.t", "id", 0, 100, 8)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8" and split["user"] == "u"
    assert query_options(db, "select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        table_options(db, "t", "id")
