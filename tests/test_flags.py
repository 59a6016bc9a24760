from __future__ import annotations

import json

import pytest
from comparing import by_key, records
from pyspark.sql import functions as F

from skuweave.functions.json_values import attribute_value, json_attribute, parse_attributes
from skuweave.operators.flags import (
    EXCLUDED_FROM_COLUMNS,
    count_true,
    merchant_columns,
    merchant_document_keys,
    population_change,
    sorted_keys,
    union_keys,
    without_keys,
)


def scoped(**values) -> str:
    return json.dumps({k: {"<all_channels>": {"<all_locales>": v}} for k, v in values.items()})


def test_columns_look_keys_up_exactly(spark):
    keys = ["a", "a_id_2"]
    df = spark.createDataFrame(
        [
            ("x", scoped(gfgh_a_enabled=True, gfgh_a_id="1", freigabe_a_id="yes")),
            ("y", scoped(gfgh_a_id_2_id="only the longer key", gfgh_a_id_2_enabled=True)),
            ("z", scoped(gfgh_a_enabled=False, gfgh_a_id=None)),
        ],
        "sku string, doc string",
    )
    names = merchant_document_keys(keys)
    parsed = df.select("sku", parse_attributes(F.col("doc"), names).alias("p"))
    values = parsed.select("sku", F.struct(*[attribute_value("p", k).alias(k) for k in names]).alias("v"))
    wide = values.select("sku", *merchant_columns("v", keys))
    counted = wide.withColumn("n", count_true(["a_enabled", "a_id_2_enabled"], offset=-2))
    rows = by_key(counted, "sku")
    assert wide.columns == [
        "sku", "a_enabled", "a_id", "a_freigabe", "a_id_2_enabled", "a_id_2_id", "a_id_2_freigabe",
    ]
    assert rows["x"]["a_enabled"] is True and rows["x"]["a_id"] == "1" and rows["x"]["a_freigabe"] == "yes"
    assert rows["y"]["a_enabled"] is False and rows["y"]["a_id"] is None
    assert rows["y"]["a_id_2_id"] == "only the longer key"
    assert rows["z"]["a_enabled"] is False and rows["z"]["a_id"] is None
    assert [rows[k]["n"] for k in "xyz"] == [-1, -1, -2]


def test_no_merchants(spark):
    assert spark.range(1).select(count_true([], offset=-2).alias("n")).first()["n"] == -2


def test_path_lookup_equals_parse(spark):
    df = spark.createDataFrame([(scoped(a=1.5, b=[1, "x"], c=None),)], "doc string")
    parsed = df.select("doc", parse_attributes(F.col("doc"), "abcd").alias("p"))
    row = parsed.select(
        *[attribute_value("p", k).alias(k) for k in "abcd"],
        *[json_attribute(F.col("doc"), k).alias(f"{k}2") for k in "abcd"],
    ).first()
    assert [row[k] for k in "abcd"] == [row[f"{k}2"] for k in "abcd"] == ["1.5", '[1,"x"]', None, None]


def test_malformed_documents_end_the_job_unless_tolerated(spark):
    df = spark.createDataFrame([(scoped(a="x"),), ("{no json",), (None,)], "doc string")

    def read(**settings):
        parsed = df.select(parse_attributes(F.col("doc"), "a", **settings).alias("p"))
        return [r["a"] for r in parsed.select(attribute_value("p", "a").alias("a")).collect()]

    assert read(tolerant=True) == ["x", None, None]
    with pytest.raises(Exception):
        read()


def keys_frame(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "merchant_key string")


def test_active_keys(spark):
    both = union_keys(keys_frame(spark, "b", "trinkkontor", None), keys_frame(spark, "a", "b", "merchant_key"))
    kept = without_keys(both, "merchant_key", EXCLUDED_FROM_COLUMNS)
    assert {r["merchant_key"] for r in records(kept)} == {"a", "b", None}
    assert sorted_keys(kept) == ["a", "b"]
    with pytest.raises(ValueError):
        sorted_keys(kept, limit=1)


@pytest.mark.parametrize("stored, changed", [(3, False), (4, True), (None, True)])
def test_population_change(spark, stored, changed):
    keys = keys_frame(spark, "a", "a", "b", None, "trinkkontor", "trinkkontor_trr")
    state = spark.createDataFrame([(stored,)], "merchant_count long")
    assert records(population_change(keys, state)) == [{"merchant_count": 3, "changed": changed}]
