from __future__ import annotations

import datetime as dt
import threading

import pytest
from comparing import by_key, records
from pyspark.sql import functions as F

from skuweave.operators.merge import append, concat, upsert
from skuweave.operators.observe import counted
from skuweave.plans.table_sync import (
    FULL_RELOAD,
    INSERT_NEW_ROWS,
    INSERT_NEW_ROWS_DROP_OLD_TABLE,
    UPSERT,
    Sync,
    run_sync,
    sync_table,
)
from skuweave.sinks.tables import (
    BUCKET,
    append_table,
    bucket_of,
    create_table_as,
    remove_versions,
    replace_buckets,
    replace_table,
    replace_view,
    upsert_partitions,
    upsert_table,
    with_json_types,
)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, v string")


def content(df) -> list:
    return sorted(((r["id"], r["v"]) for r in df.collect()), key=str)


def test_upsert(spark):
    target = frame(spark, (1, "old"), (2, "old"), (None, "no key"))
    batch = frame(spark, (2, "new"), (3, "new"), (3, "again"), (None, "new"))
    merged = upsert(target, batch, "id")
    assert content(merged) == sorted(
        [(1, "old"), (2, "new"), (3, "new"), (3, "again"), (None, "no key"), (None, "new")], key=str
    )
    keyed = batch.where("id is not null")
    assert content(upsert(upsert(target, keyed, "id"), keyed, "id")) == content(upsert(target, keyed, "id"))
    assert content(upsert(target, batch.limit(0), "id")) == content(target)


def test_appending_and_stacking(spark):
    a, b = frame(spark, (1, "a")), spark.createDataFrame([(2, 5)], "id long, w long")
    assert append(a, a).count() == 2
    assert by_key(concat([a, b]), "id")[2] == {"id": 2, "v": None, "w": 5}


NOW = dt.datetime(2024, 5, 15, 9)


def source(spark):
    return spark.createDataFrame(
        [(1, "a", dt.datetime(2024, 5, 14)), (2, "b", dt.datetime(2024, 5, 1)), (3, "c", dt.datetime(2023, 1, 1))],
        "id long, v string, updated_at timestamp",
    )


@pytest.mark.parametrize(
    "mode, expected",
    [
        (FULL_RELOAD, {1: "a", 2: "b", 3: "c"}),
        (UPSERT, {1: "a", 7: "kept"}),
        (INSERT_NEW_ROWS_DROP_OLD_TABLE, {1: "a", 2: "b"}),
    ],
)
def test_sync_modes(spark, mode, expected):
    target = source(spark).where("id = 1").withColumn("v", F.lit("old")).withColumn("_updated_at", F.lit(NOW))
    target = target.unionByName(target.withColumn("id", F.lit(7).cast("long")).withColumn("v", F.lit("kept")))
    done = sync_table(source(spark), target, Sync(mode, look_back_days=20), "2024-05-15", F.lit(NOW))
    assert {r["id"]: r["v"] for r in records(done)} == expected
    assert all(r["_updated_at"] == NOW for r in records(done))


def test_inserting_again_adds_again(spark):
    sync = Sync(INSERT_NEW_ROWS)
    once = sync_table(source(spark), None, sync, "2024-05-15", F.lit(NOW))
    twice = sync_table(source(spark), once, sync, "2024-05-15", F.lit(NOW))
    assert [r["id"] for r in records(twice)] == [1, 1]


def test_unknown_mode():
    with pytest.raises(ValueError):
        Sync("SOMETIMES")


def test_tables_are_replaced_while_read(spark, tmp_path):
    root, table = str(tmp_path), "replaced"
    first = replace_table(frame(spark, (1, "a"), (2, "b")), table, root)
    second = upsert_table(frame(spark, (2, "new"), (3, "c")), table, "id", root)
    assert first != second
    assert content(spark.table(table)) == [(1, "a"), (2, "new"), (3, "c")]
    append_table(frame(spark, (4, "d")), table)
    assert spark.table(table).count() == 4
    replace_table(spark.createDataFrame([(1,)], "other long"), table, root)
    assert spark.table(table).columns == ["other"]
    create_table_as(spark, table, frame(spark, (5, "e")))
    create_table_as(spark, table, frame(spark, (6, "f")))
    assert content(spark.table(table)) == [(6, "f")]
    spark.sql(f"DROP TABLE {table}")


def test_partitioned_table(spark, tmp_path):
    df = frame(spark, (1, "a"), (2, "b")).withColumn("month", F.col("id") % 2)
    replace_table(df, "parted", str(tmp_path), ["month"])
    assert content(spark.table("parted")) == [(1, "a"), (2, "b")]
    spark.sql("DROP TABLE parted")


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)], "id long, v string, month int")
    rows.write.partitionBy("month").parquet(path)
    before = {p.name for p in (tmp_path / "t" / "month=2").iterdir()}
    batch = spark.createDataFrame([(2, "new", 1), (4, "d", 3)], "id long, v string, month int")
    upsert_partitions(batch, path, "id", "month")
    upsert_partitions(batch.limit(0), path, "id", "month")
    assert content(spark.read.parquet(path)) == [(1, "a"), (2, "new"), (3, "c"), (4, "d")]
    assert {p.name for p in (tmp_path / "t" / "month=2").iterdir()} == before


def test_keys_that_move_leave_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(
        [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", None)], "id long, v string, month int"
    )
    rows.write.partitionBy("month").parquet(path)
    batch = spark.createDataFrame([(1, "new", 2), (4, "new", 2), (3, "new", 5)], "id long, v string, month int")
    upsert_partitions(batch, path, "id", "month")
    found = sorted(map(tuple, spark.read.parquet(path).select("id", "v", "month").collect()))
    assert found == [(1, "new", 2), (2, "b", 1), (3, "new", 5), (4, "new", 2)]
    # The only rows of month 1 and of the null month: their folders go.
    upsert_partitions(batch.limit(0).union(spark.createDataFrame([(2, "x", 2)], batch.schema)), path, "id", "month")
    assert {p.name for p in (tmp_path / "t").iterdir() if "=" in p.name} == {"month=2", "month=5"}


def test_new_columns_are_appended(spark, tmp_path):
    replace_table(frame(spark, (1, "a")), "widened", str(tmp_path))
    append_table(frame(spark, (2, "b")).withColumn("extra", F.lit(7)), "widened")
    append_table(frame(spark, (3, "c")).select("v", "id"), "widened")
    rows = sorted(map(tuple, spark.table("widened").select("id", "v", "extra").collect()))
    assert rows == [(1, "a", None), (2, "b", 7), (3, "c", None)]
    spark.sql("DROP TABLE widened")


def test_failing_replacement_keeps_the_table(spark, tmp_path):
    replace_table(frame(spark, (1, "a")), "steady", str(tmp_path))
    failing = frame(spark, (2, "b")).select(F.raise_error(F.lit("no")).cast("string").alias("other"))
    with pytest.raises(Exception):
        replace_table(failing, "steady", str(tmp_path))
    with pytest.raises(Exception):
        create_table_as(spark, "steady", failing)
    assert content(spark.table("steady")) == [(1, "a")]
    create_table_as(spark, "steady", spark.table("steady").withColumn("v", F.lit("own")))
    assert content(spark.table("steady")) == [(1, "own")]
    spark.sql("DROP TABLE steady")


def test_readers_find_a_table_while_its_shape_changes(spark, tmp_path):
    """A reader in a loop sees each version whole and never a moment without one."""
    shapes = [frame(spark, (1, "a")), spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), spark.createDataFrame([(7,)], "other long")]
    replace_view(shapes[0], "shown", str(tmp_path))
    seen, wrong, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                rows = spark.table("shown").collect()
                seen.add(tuple(rows[0].asDict()))
                if len(rows) != 1:
                    wrong.append(rows)
            except Exception as problem:
                wrong.append(problem)

    reader = threading.Thread(target=read)
    reader.start()
    for turn in range(9):
        replace_view(shapes[(turn + 1) % 3], "shown", str(tmp_path))
    done.set()
    reader.join()
    assert wrong == [] and seen <= {("id", "v"), ("a", "b", "c"), ("other",)}
    failing = frame(spark, (2, "b")).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception):
        replace_view(failing, "shown", str(tmp_path))
    assert spark.table("shown").columns == ["id", "v"]
    assert remove_versions(spark, "shown", str(tmp_path), keep=1) >= 8
    assert sum(t.name.startswith("shown__") for t in spark.catalog.listTables()) <= 2
    assert content(spark.table("shown")) == [(1, "a")]


def test_only_buckets_of_changed_keys_are_rewritten(spark, tmp_path):
    rows = spark.range(200).select("id", F.lit("old").alias("v")).withColumn(BUCKET, bucket_of(F.col("id"), 16))
    version = replace_view(rows.repartition(4, BUCKET), "bucketed", str(tmp_path), [BUCKET], [BUCKET])
    folder = next((tmp_path / "bucketed").iterdir())
    files = lambda: {p.name: {f.name for f in p.iterdir()} for p in folder.iterdir() if "=" in p.name}
    before = files()
    gone = spark.createDataFrame([(3,), (4,), (500,)], "id long")
    batch = spark.createDataFrame([(3, "new"), (500, "new")], "id long, v string")
    touched = replace_buckets(spark, version, gone, batch, "id", 16)
    assert 1 <= len(touched) <= 3
    spark.catalog.refreshTable("bucketed")
    found = {r["id"]: r["v"] for r in records(spark.table("bucketed"))}
    assert found == {**{i: "old" for i in range(200) if i != 4}, 3: "new", 500: "new"}
    after = files()
    assert {name for name in before if before[name] != after[name]} == {f"{BUCKET}={b}" for b in touched}
    # A bucket that loses all its rows goes; nothing changed means nothing written.
    own = spark.table(version).where(F.col(BUCKET) == touched[0]).select("id")
    replace_buckets(spark, version, own, batch.limit(0), "id", 16)
    assert f"{BUCKET}={touched[0]}" not in files()
    left = {r["id"] for r in records(spark.table(version))}
    assert left == {i for i in found if i not in {r["id"] for r in records(rows.unionByName(batch.withColumn(BUCKET, bucket_of(F.col("id"), 16))).where(F.col(BUCKET) == touched[0]))}}
    still = files()
    assert replace_buckets(spark, version, gone.limit(0), batch.limit(0), "id", 16) == [] and files() == still


def test_old_versions_are_removed_on_request(spark, tmp_path):
    for value in "abcd":
        replace_table(frame(spark, (1, value)), "kept", str(tmp_path))
    assert remove_versions(spark, "kept", str(tmp_path), keep=1) == 3
    assert len(list((tmp_path / "kept").iterdir())) == 1
    assert content(spark.table("kept")) == [(1, "d")]
    assert remove_versions(spark, "never", str(tmp_path)) == 0
    spark.sql("DROP TABLE kept")


def test_first_upsert_copies_everything(spark, tmp_path):
    run_sync(source(spark), "first", str(tmp_path), Sync(UPSERT), "2024-05-15")
    assert spark.table("first").count() == source(spark).count()
    spark.sql("DROP TABLE first")


def test_partitioned_sync_rewrites_what_it_touches(spark, tmp_path):
    sync = Sync(UPSERT, partition_by="id")
    run_sync(source(spark), "by_id", str(tmp_path), sync, "2024-05-15")
    folders = {p.name: {f.name for f in p.iterdir()} for v in (tmp_path / "by_id").iterdir() for p in v.iterdir() if "=" in p.name}
    run_sync(source(spark).withColumn("v", F.lit("changed")), "by_id", str(tmp_path), sync, "2024-05-15")
    after = {p.name: {f.name for f in p.iterdir()} for v in (tmp_path / "by_id").iterdir() for p in v.iterdir() if "=" in p.name}
    assert {r["id"]: r["v"] for r in records(spark.table("by_id"))} == {1: "changed", 2: "b", 3: "c"}
    assert {name for name in folders if folders[name] != after[name]} == {"id=1"}
    spark.sql("DROP TABLE by_id")


def test_partition_values_keep_their_type(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a", "01"), (2, "b", "02")], "id long, v string, month string")
    rows.write.partitionBy("month").parquet(path)
    upsert_partitions(rows.where("id = 1").withColumn("v", F.lit("new")), path, "id", "month")
    assert {p.name for p in (tmp_path / "t").iterdir() if "=" in p.name} == {"month=01", "month=02"}
    assert content(spark.read.parquet(path)) == [(1, "new"), (2, "b")]


def test_sync_job(spark, tmp_path):
    root = str(tmp_path)
    data = source(spark).withColumn("data", F.lit('{ "k": [1, 2] }'))
    run_sync(data, "synced", root, Sync(FULL_RELOAD))
    assert spark.table("synced").count() == 3
    assert {r["data"] for r in records(spark.table("synced"))} == {'{"k":[1,2]}'}
    changed = data.withColumn("v", F.lit("changed"))
    run_sync(changed, "synced", root, Sync(UPSERT), "2024-05-15")
    run_sync(changed, "synced", root, Sync(UPSERT), "2024-05-15")
    assert {r["id"]: r["v"] for r in records(spark.table("synced"))} == {1: "changed", 2: "b", 3: "c"}
    run_sync(changed, "synced", root, Sync(INSERT_NEW_ROWS), "2024-05-15")
    assert spark.table("synced").count() == 4
    spark.sql("DROP TABLE synced")


def test_json_types(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"a": 1}')], "id long, raw_values string")
    typed = with_json_types(df)
    assert typed.schema["raw_values"].dataType.simpleString() == "variant"
    typed.write.parquet(str(tmp_path / "typed"))
    stored = spark.read.parquet(str(tmp_path / "typed"))
    assert stored.select(F.variant_get("raw_values", "$.a", "int")).first()[0] == 1


def test_row_count_comes_with_the_load(spark):
    df, rows = counted(frame(spark, (1, "a"), (2, "b")))
    df.collect()
    assert rows.get["rows"] == 2
