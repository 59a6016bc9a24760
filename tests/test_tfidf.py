from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from comparing import records

from skuweave.operators.tfidf import first_matches, inverse_document_frequency, tfidf_match
from skuweave.plans.matching import EXCLUDED_TYPE, attach_matches, match_by_tfidf, matched_rows, number_rejects, tfidf_catalog


def grams(name: str, n: int = 3) -> list[str]:
    text = re.sub(r"[,-./]|\sBD", "", name)
    return [text[i : i + n] for i in range(len(text) - n + 1)]


def brute_force(catalog: list[str], inputs: list[str], top: int, least: float) -> set:
    """Every name against every name, by the definition."""
    df = Counter(g for name in catalog for g in set(grams(name)))
    idf = {g: math.log((1 + len(catalog)) / (1 + n)) + 1 for g, n in df.items()}

    def vector(name):
        w = {g: n * idf[g] for g, n in Counter(grams(name)).items() if g in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {g: x / norm for g, x in w.items()}

    vectors = {name: vector(name) for name in set(catalog)}
    found = set()
    for name in set(inputs):
        v = vector(name)
        scores = [(round(sum(x * c.get(g, 0.0) for g, x in v.items()), 9), other) for other, c in vectors.items()]
        best = sorted((s for s in scores if s[0] > least), key=lambda s: (-s[0], s[1]))[:top]
        found |= {(name, other, round(score, 6)) for score, other in best}
    return found


def frames(spark, catalog, inputs):
    return (
        spark.createDataFrame([(n,) for n in catalog], "sku_title string"),
        spark.createDataFrame([(n,) for n in inputs], "name string"),
    )


def result(df) -> set:
    return {(r["name_input"], r["name_all_skus"], round(r["similarity"], 6)) for r in df.collect()}


def names(seed: int, count: int) -> list[str]:
    rng = random.Random(seed)
    words = ["cola", "light", "water", "still", "Bier", "Pils", "0,5", "0.33", "BD", "kiste", "x", "ü/ö"]
    return [
        " ".join(rng.choice(words) for _ in range(rng.randint(0, 5))) + f" {rng.randint(1, 12)}x{rng.choice(words)}"
        for _ in range(count)
    ]


@pytest.mark.parametrize("cell_rows", [2_048, 7, 3])
@pytest.mark.parametrize("top, least", [(1, 0.5), (3, 0.2)])
def test_equals_brute_force(spark, cell_rows, top, least):
    catalog, inputs = names(1, 120), names(2, 150)
    c, i = frames(spark, catalog, inputs)
    found = tfidf_match(c, i, top=top, min_score=least, cell_rows=cell_rows)
    assert result(found) == brute_force(catalog, inputs, top, least)


@pytest.mark.parametrize("top, least, good", [(2, 0.3, 0.95), (1, 0.5, 0.5), (4, 0.05, 0.6)])
def test_passes_change_the_work_only(spark, top, least, good):
    catalog, inputs = names(3, 90), names(4, 110)
    c, i = frames(spark, catalog, inputs)
    assert result(tfidf_match(c, i, top=top, min_score=least, good=good)) == brute_force(catalog, inputs, top, least)


def test_few_pairs_are_compared(spark):
    """Copies with a typing error among names of many words: about the matches themselves."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(400)]
    catalog = [" ".join(rng.choice(words) for _ in range(4)) for _ in range(600)]
    inputs = [name[:9] + "#" + name[10:] for name in catalog]
    c, i = frames(spark, catalog, inputs)
    compared = spark.sparkContext.accumulator(0)
    found = result(tfidf_match(c, i, compared=compared))
    assert len(found) == len(set(inputs)) and sum(a[:9] == b[:9] for a, b, _ in found) > 0.99 * len(found)
    assert compared.value < 0.02 * len(catalog) * len(inputs)


@pytest.mark.parametrize("top, least", [(1, 0.3), (3, 0.2), (2, 0.0)])
def test_names_alike_but_for_what_the_other_side_lacks(spark, top, least):
    """Codes that only one side has: a product does not see them, so few names are compared."""
    rng = random.Random(8)
    stems = ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(15)]
    catalog = [f"{stem} {rng.choice(['QQ', 'QQQ', 'RSTU'])}{rng.randint(0, 9)}{chr(75 + i % 9)}" for stem in stems for i in range(30)]
    inputs = [f"{stem} {chr(120 + i % 3)}{i}" for stem in stems for i in range(30)]
    c, i = frames(spark, catalog, inputs)
    compared = spark.sparkContext.accumulator(0)
    assert result(tfidf_match(c, i, top=top, min_score=least, compared=compared)) == brute_force(catalog, inputs, top, least)
    if top == 1:
        assert compared.value < 0.02 * len(set(catalog)) * len(set(inputs))


def test_one_hot_name_and_hot_ngrams(spark):
    """A third of both sides is one name, and all names share their n-grams."""
    catalog = ["cola light 6x0,5"] * 60 + [f"cola light {i}x0,5" for i in range(60)]
    inputs = ["cola lihgt 6x0,5"] * 60 + [f"cola light {i} x0.5" for i in range(60)]
    c, i = frames(spark, catalog, inputs)
    found = tfidf_match(c, i, cell_rows=10)
    assert result(found) == brute_force(catalog, inputs, 1, 0.5)
    assert found.count() == len(set(inputs))


def test_names_that_cannot_match(spark):
    catalog = ["water still", "ab", "", "water still"]
    c, i = frames(spark, catalog, ["xyz unseen", "ab", "", "water", None])
    assert result(tfidf_match(c, i)) == brute_force(catalog, ["water"], 1, 0.5)
    empty = spark.createDataFrame([], "name string")
    assert tfidf_match(c, empty).count() == 0
    assert tfidf_match(empty.withColumnRenamed("name", "sku_title"), i).count() == 0


def test_copies_weigh_in_the_frequencies(spark):
    c, _ = frames(spark, ["abcd", "abcd", "xbcd"], [])
    idf = {r["gram"]: (r["df"], r["idf"]) for r in records(inverse_document_frequency(c, "sku_title"))}
    assert idf["abc"] == (2, pytest.approx(math.log(4 / 3) + 1))
    assert idf["bcd"] == (3, pytest.approx(1.0))


def test_names_are_not_crossed(spark):
    c, i = frames(spark, names(1, 20), names(2, 20))
    plan = tfidf_match(c, i)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_cap_on_matches(spark):
    df = spark.createDataFrame([(f"n{i}", "x", 0.9) for i in range(5)], "name_input string, name_all_skus string, similarity double")
    assert {r["name_input"] for r in first_matches(df, 2).collect()} == {"n0", "n1"}
    assert first_matches(df, 0).count() == 5


SKUS = "identifier string, brand string, title string, base_code string, type_single_unit string, enablement int, amount_single_unit string, net_content string"


def test_catalogue_filter(spark):
    rows = [
        ("1", "b", "t", "c", "type", 1, "6", "0,5"),
        ("2", "b", "t", "c", "type", 0, "6", "0,5"),
        ("3", "b", "t", "c", EXCLUDED_TYPE, 1, "6", "0,5"),
        ("4", "b", "t", None, "type", 1, "6", "0,5"),
        ("5", "b", "t", "c", "type", 1, "6", None),
        ("6", "b", "t", "c", None, 1, "6", "0,5"),
        ("7", None, "t", "c", "type", 1, None, "0,5"),
    ]
    found = {r["sku"]: r["sku_title"] for r in records(tfidf_catalog(spark.createDataFrame(rows, SKUS)))}
    assert found == {"1": "b t 6x0,5", "7": " t x0,5"}


def test_one_row_per_input_with_equal_units(spark):
    catalog = spark.createDataFrame(
        [("s2", "title a", "6", "0,5"), ("s1", "title a", "6", "0,7"), ("s0", "title a", "12", "1"), ("s9", "title a", "six", "1")],
        "sku string, sku_title string, amount_single_unit string, net_content string",
    )
    inputs = spark.createDataFrame(
        [(1, "in a", "6", "x"), (1, "in a", "12", "x"), (2, "in a", "24", "x"), (3, "other", "6", "x"), (4, "in a", "12", None)],
        "gfgh_id long, name string, no_of_base_units string, base_unit_content string",
    )
    matches = spark.createDataFrame([("in a", "title a", 0.8)], "name_input string, name_all_skus string, similarity double")
    found = {r["gfgh_id"]: r for r in records(attach_matches(matches, catalog, inputs, tolerant=True))}
    with pytest.raises(ValueError, match="not a number: six"):
        attach_matches(matches, catalog, inputs)
    assert set(found) == {1, 4}
    assert found[4]["sku"] == "s0"
    assert found[1]["sku"] == "s0" and found[1]["no_of_base_units_input"] == 12
    assert isinstance(found[1]["base_unit_content_all_skus"], float)


def test_only_matched_rows_must_parse(spark):
    catalog = spark.createDataFrame(
        [("s1", "title a", "6", "0,7"), ("s2", "title b", "six", "much"), ("s3", "title a", None, "0,7")],
        "sku string, sku_title string, amount_single_unit string, net_content string",
    )
    inputs = spark.createDataFrame(
        [(1, "in a", "6", "x"), (2, "in b", "many", "x")],
        "gfgh_id long, name string, no_of_base_units string, base_unit_content string",
    )
    kind = "name_input string, name_all_skus string, similarity double"
    matches = spark.createDataFrame([("in a", "title a", 0.8)], kind)
    assert [r["sku"] for r in records(attach_matches(matches, catalog, inputs))] == ["s1"]
    every = spark.createDataFrame([("in a", "title a", 0.8), ("in b", "title b", 0.9)], kind)
    _, products, asked = matched_rows(every, catalog, inputs)
    wrong = {(r["side"], r["key"], r["column"], r["text"]) for r in records(number_rejects(products, asked))}
    assert wrong == {
        ("catalogue", "s2", "amount_single_unit", "six"),
        ("catalogue", "s2", "net_content", "much"),
        ("input", "2", "no_of_base_units", "many"),
    }
    with pytest.raises(ValueError, match="3 in all"):
        attach_matches(every, catalog, inputs)


def test_job(spark):
    rows = [(str(i), "brand", f"product {i % 7}", "c", "t", 1, str(i % 3), "0,5") for i in range(30)]
    inputs = [(i, f"brand produkt {i % 7} {i % 3}x0,5", str(i % 3), "0,5 l") for i in range(30)]
    found = match_by_tfidf(
        spark.createDataFrame(rows, SKUS),
        spark.createDataFrame(inputs, "gfgh_id long, name string, no_of_base_units string, base_unit_content string"),
    )
    rows = records(found)
    assert len({r["gfgh_id"] for r in rows}) == len(rows) > 0
    assert all(r["no_of_base_units_input"] == r["no_of_base_units_all_skus"] for r in rows)
    counts = defaultdict(set)
    for r in rows:
        counts[r["name_input"]].add(r["sku"])
    assert all(len(skus) == 1 for skus in counts.values())
