from __future__ import annotations

import json

from comparing import by_key

from skuweave.operators.attributes import PRODUCT_ATTRIBUTES, attributes, resolve_attributes


def doc(**values) -> str:
    return json.dumps({k: {"<all_channels>": {"<all_locales>": v}} for k, v in values.items()})


MODELS = [
    (1, 10, "m-one", doc(title="model title", brand="model brand")),
    (2, None, "lonely", doc(title="lonely title")),
    (3, 10, None, doc(net_content=5)),
    (10, None, "parent", doc(title="parent title", brand="parent brand", net_content="9", shop_enabled=True)),
]
PRODUCTS = [
    ("a", 1, doc(title="own title", brand="own brand")),
    ("b", 1, doc(brand=None, title='with "quotes"')),
    ("c", 2, doc(brand='7" disc')),
    ("d", None, doc(title="alone", golden_record_level1="g")),
    ("e", 3, doc()),
    ("f", 99, doc(title="unknown model")),
    ("g", None, None),
]


def resolved(spark, wanted=PRODUCT_ATTRIBUTES, **settings):
    products = spark.createDataFrame(PRODUCTS, "identifier string, product_model_id long, raw_values string")
    models = spark.createDataFrame(MODELS, "id long, parent_id long, code string, raw_values string")
    return by_key(resolve_attributes(products, models, wanted, **settings), "identifier")


def test_both_precedence_orders(spark):
    rows = resolved(spark)
    assert rows["a"]["title"] == "model title"
    assert rows["a"]["brand"] == "own brand"
    # A JSON null is passed over.
    assert rows["b"]["brand"] == "model brand"
    assert rows["e"]["brand"] == "parent brand"


def test_levels_and_missing_values(spark):
    rows = resolved(spark)
    assert rows["a"]["net_content"] == "9"
    assert rows["a"]["shop_enabled"] == "true"
    assert rows["e"]["net_content"] == "5"
    assert rows["d"]["title"] == "alone"
    assert rows["d"]["release_l1"] == rows["d"]["golden_record_level1"] == "g"
    assert rows["f"]["title"] == "unknown model"
    assert rows["c"]["contact_info"] is None
    assert rows["g"]["title"] is None


def test_quotes_are_removed(spark):
    assert resolved(spark)["c"]["brand"] == "7 disc"


def test_codes(spark):
    rows = resolved(spark)
    assert (rows["a"]["l1_code"], rows["a"]["base_code"], rows["a"]["is_manual"]) == ("m-one", "parent", True)
    assert (rows["c"]["l1_code"], rows["c"]["base_code"], rows["c"]["is_manual"]) == ("lonely", "lonely", False)
    assert (rows["e"]["l1_code"], rows["e"]["base_code"]) == ("parent", "parent")
    assert (rows["d"]["l1_code"], rows["d"]["base_code"], rows["d"]["is_manual"]) == (None, None, False)


def test_number_of_attributes_and_rows(spark):
    assert len(PRODUCT_ATTRIBUTES) == 20
    assert sum(a.product_first for a in PRODUCT_ATTRIBUTES) == 6
    assert len(resolved(spark)) == len(PRODUCTS)


def test_extra_keys_come_from_the_same_parse(spark):
    rows = resolved(spark, attributes(["title"]), extra_keys=["brand", "absent"])
    assert rows["a"]["_values"] == {"brand": "own brand", "absent": None}
