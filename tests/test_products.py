from __future__ import annotations

import datetime as dt
import json

from comparing import by_key, records

from skuweave.plans.products import ProductSources, delta_load, full_load, needs_full_load

DAY = dt.datetime(2024, 5, 15)
OLD = dt.datetime(2024, 1, 1)


def doc(**values) -> str:
    return json.dumps({k: {"<all_channels>": {"<all_locales>": v}} for k, v in values.items()})


def sources(spark, products=None, merchants=("m1", "trinkkontor")) -> ProductSources:
    products = products or [
        ("a", 1, 7, doc(brand="b1", gfgh_m1_enabled=True, gfgh_m1_id="x"), OLD, OLD),
        ("a", 1, 7, doc(brand="newer", gfgh_m1_enabled=True), OLD, DAY),
        ("b", None, 7, doc(title="t", net_content_uom="u1"), OLD, OLD),
        ("no category", 1, 7, doc(), OLD, OLD),
    ]
    make = spark.createDataFrame
    return ProductSources(
        products=make(
            products,
            "identifier string, product_model_id long, family_id long, raw_values string, created timestamp, updated timestamp",
        ),
        models=make(
            [(1, None, "m-1", doc(title="model"), OLD, OLD)],
            "id long, parent_id long, code string, raw_values string, created timestamp, updated timestamp",
        ),
        distributor=make(
            [("a", "6", "maker"), ("a", "8", None), (None, "99", "none")], "sku string, no_of_base_units string, manufacturer string"
        ),
        options=make([(1, "u1"), (2, "u2")], "id long, code string"),
        option_values=make([(1, "u2"), (2, "litre")], "option_id long, value string"),
        categories=make([("a", "c1", "t"), ("b", "c2", "t"), ("b", "c2", "t")], "sku string, l1 string, title string"),
        merchants_new=make([(m,) for m in merchants], "merchant_key string"),
        merchants_active=make([("m1",), (None,)], "merchant_key string"),
    )


def test_full_load(spark):
    rows = by_key(full_load(sources(spark)), "identifier")
    assert set(rows) == {"a", "b"}
    a, b = rows["a"], rows["b"]
    assert a["brand"] == "newer" and a["title"] == "model" and a["is_manual"]
    assert a["no_of_base_units"] == "8" and a["manufacturer_gfgh_data"] == "|maker|"
    assert a["m1_enabled"] is True and a["m1_id"] is None and a["enablement"] == -1
    assert b["net_content_uom"] == "litre" and b["l1"] == "c2" and b["enablement"] == -2
    assert b["manufacturer_gfgh_data"] is None and b["sku_gfghdata"] is None
    assert "family_id" not in a and "raw_values" not in a and "trinkkontor_enabled" not in a
    assert list(a)[0] == "identifier"


def test_delta_equals_full_load_of_the_new_state(spark):
    before = full_load(sources(spark), with_manufacturer_mark=False)
    changed = [
        ("a", 1, 7, doc(brand="changed"), OLD, DAY),
        ("b", None, 7, doc(title="t", net_content_uom="u1"), OLD, OLD),
        ("no category", 1, 7, doc(), OLD, DAY),
    ]
    after = sources(spark, changed)
    delta = delta_load(before, after, "2024-05-16")
    full = full_load(after, with_manufacturer_mark=False)
    assert delta.columns == full.columns
    assert by_key(delta, "identifier") == by_key(full, "identifier")
    assert by_key(delta, "identifier")["a"]["brand"] == "changed"


def test_unchanged_rows_survive_a_delta(spark):
    before = full_load(sources(spark))
    quiet = sources(spark, [("b", None, 7, doc(title="ignored"), OLD, OLD)])
    after = delta_load(before, quiet, "2024-05-16")
    assert by_key(after, "identifier") == by_key(before, "identifier")


def test_model_change_reaches_its_products(spark):
    s = sources(spark, [("a", 1, 7, doc(), OLD, OLD), ("b", None, 7, doc(), OLD, OLD)])
    models = s.models.withColumn("updated", s.models.created + dt.timedelta(days=135))
    before = full_load(s)
    after = delta_load(before, ProductSources(**{**vars(s), "models": models}), "2024-05-16")
    rows = by_key(after, "identifier")
    assert set(rows) == {"a", "b"} and rows["a"]["manufacturer_gfgh_data"] is None
    assert rows["b"] == by_key(before, "identifier")["b"]


def test_need_for_a_full_load(spark):
    state = spark.createDataFrame([(2,)], "merchant_count long")
    # A null key counts as one.
    assert records(needs_full_load(sources(spark), state)) == [{"merchant_count": 2, "changed": False}]
    assert records(needs_full_load(sources(spark, merchants=("m1", "m2")), state)) == [
        {"merchant_count": 3, "changed": True}
    ]


def test_wide_rows_move_once_for_the_model_and_once_for_the_identifier(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = full_load(sources(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(identifier" in line]
    assert len(exchanges) == 1
    assert plan.count("Exchange hashpartitioning(product_model_id") == 1
