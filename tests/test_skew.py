"""Hot keys: how Spark executes the plans when one key holds a third of the rows."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from skuweave.operators.attributes import attributes, resolve_attributes
from skuweave.operators.cells import PLACE, meet
from skuweave.operators.merge import upsert


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "200KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__shuffle__partitions": "16",
}


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_and_missing_models_are_split(spark):
    document = F.format_string(
        '{"title":{"<all_channels>":{"<all_locales>":"%s %s"}}}', F.sha2(F.col("id").cast("string"), 512), F.col("id")
    )
    products = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("identifier"),
        F.expr("CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN id % 500 END").alias("product_model_id"),
        document.alias("raw_values"),
    )
    models = spark.range(500).select(
        "id", F.lit(None).cast("long").alias("parent_id"), F.lit("m-1").alias("code"), F.lit("{}").alias("raw_values")
    )
    with settings(spark, **SMALL):
        resolved = resolve_attributes(products, models, attributes(["title"]))
        resolved.write.format("noop").mode("overwrite").save()
        counted = resolved.groupBy(F.col("l1_code").isNull().alias("none")).count()
        assert {r["none"]: r["count"] for r in counted.collect()} == {True: 20_000, False: 40_000}
        collected = resolved.select("identifier", "title", "l1_code")
        assert len(collected.collect()) == 60_000
        assert "skew=true" in executed_plan(collected)


def test_hot_key_of_a_merge_target_is_split(spark):
    target = spark.range(0, 60_000, 1, 8).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v")
    )
    batch = target.where("k % 1000 = 1")
    with settings(spark, **SMALL):
        merged = upsert(target, batch, "k")
        assert len(merged.collect()) == 60_000
        assert "skew=true" in executed_plan(merged)


def test_cells_stay_small(spark):
    """A third of the rows on one key: no cell holds much more than its size."""
    rows = spark.range(9_000).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END").alias("key"))
    left, right = meet(rows, rows, "key", cell_rows=100)
    for side in (left, right):
        largest = side.groupBy(*PLACE).count().agg(F.max("count")).first()[0]
        assert largest < 250
    met = left.alias("a").join(right.alias("b"), [*PLACE]).where("a.key = b.key")
    assert met.count() == 3_000 * 3_000 + 6_000
