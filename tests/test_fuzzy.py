from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from comparing import records
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from skuweave.functions.text import common_lengths, edit_ratio, lcs_length, one_contains_other, tokens
from skuweave.operators import fuzzy
from skuweave.operators.fuzzy import RESULT_COLUMNS, fuzzy_match
from skuweave.plans.matching import edit_catalog, match_by_edit_ratio


def plain_lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b, 1):
            new.append(row[k - 1] + 1 if x == y else max(row[k], new[-1]))
        row = new
    return row[-1]


def plain_ratio(a: str, b: str) -> int:
    return 100 if a == b else round(200 * plain_lcs(a, b) / (len(a) + len(b)))


@given(st.text("abcü€𝄞 ", max_size=90), st.text("abcü€𝄞 ", max_size=90))
def test_lcs_length(a, b):
    assert lcs_length(a, b) == plain_lcs(a, b)


@given(st.lists(st.text("abcü€𝄞 ", max_size=200), min_size=1, max_size=8), st.lists(st.text("abcü€𝄞x", max_size=200), min_size=1, max_size=8))
def test_common_lengths_of_many_pairs(a, b):
    i, j = np.indices((len(a), len(b))).reshape(2, -1)
    found = common_lengths(a, b, i, j, block=5)
    assert found.tolist() == [plain_lcs(a[k], b[m]) for k, m in zip(i, j)]


def test_common_lengths_of_long_names():
    rng = random.Random(3)
    names = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (1, 63, 64, 65, 127, 128, 129, 200, 1_000)]
    i, j = np.indices((len(names), len(names))).reshape(2, -1)
    assert common_lengths(names, names, i, j).tolist() == [lcs_length(names[k], names[m]) for k, m in zip(i, j)]


PAIRS = [
    ("kitten", "sitting"), ("same", "same"), ("", ""), ("", "x"), (None, "x"), ("x", None), ("Case", "case"),
    ("abcdef", "fedcba"), ("a" * 139 + "b" * 61, "a" * 139 + "c" * 61), ("𝄞𝄞a", "𝄞b"),
]


def test_edit_ratio(spark):
    df = spark.createDataFrame(PAIRS, "a string, b string")
    found = [r["r"] for r in df.select(edit_ratio(F.col("a"), F.col("b")).alias("r")).collect()]
    expected = [0 if a is None or b is None else plain_ratio(a, b) for a, b in PAIRS]
    assert found == expected
    # 69.5 is rounded to 70.
    assert found[8] == 70


@pytest.mark.parametrize(
    "a, b, agree",
    [
        ("0,33", "0.33", True), ("0,33 l", "0.33", True), ("0,33", "0,5", False), ("L 0,5", "0,5 l", True),
        ("", "", False), (None, None, False), ("--", "--", False), ("6", "6er Kiste", False), ("a_b", "a b", False),
        ("é 1", "1", True), ("x  y", "y", True),
    ],
)
def test_token_sets(spark, a, b, agree):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    words = df.select(tokens(F.col("a")).alias("a"), tokens(F.col("b")).alias("b"))
    assert bool(words.select(one_contains_other(F.col("a"), F.col("b"))).first()[0]) is agree


CATALOG = "identifier string, name string, base_unit_content string, no_of_base_units string"
INPUT = "gfgh_id long, name string, no_of_base_units string, base_unit_content string, structure_packaging_unit string"


def words(text) -> set:
    return set("".join(c if c.isalnum() or c == "_" else " " for c in text).lower().split())


def agree(a, b) -> bool:
    if a is None or b is None:
        return False
    a, b = words(a), words(b)
    return bool(a and b and (a <= b or b <= a))


def brute_force(catalog, inputs, min_ratio=70) -> list:
    """Every catalogue row against every input row."""
    found = {}
    for ident, name, content, units in catalog:
        for gid, other, other_units, other_content, structure in inputs:
            if name is None or other is None or not agree(units, other_units) or not agree(content, other_content):
                continue
            ratio = plain_ratio(name, other)
            if ratio >= min_ratio:
                key = (name, ident, gid, other, ratio)
                rest = (content, units, other_units, other_content, structure)
                found[key] = min(found.get(key, rest), rest)
    return sorted(
        (name, ident, c, u, gid, other, qu, qc, s, ratio, 100, 100)
        for (name, ident, gid, other, ratio), (c, u, qu, qc, s) in found.items()
    )


def sample(seed: int, count: int) -> list:
    rng = random.Random(seed)
    stems = ["Cola light", "cola zero", "Wasser still", "Pils", "Weizen alkoholfrei", "x" * 70]
    contents = ["0,33", "0.33 l", "0,5", "0.5 L", "1", "", None, "l"]
    units = ["6", "12", "24", "6 x 4", None]
    return [
        (
            i,
            None if rng.random() < 0.03 else rng.choice(stems) + " " + "".join(rng.choice("abc1 ") for _ in range(rng.randint(0, 6))),
            rng.choice(contents),
            rng.choice(units),
        )
        for i in range(count)
    ]


@pytest.mark.parametrize("cell_rows", [2_048, 5, 3])
def test_equals_brute_force(spark, cell_rows):
    catalog = [(f"i{i}", name, content, units) for i, name, content, units in sample(1, 150)]
    inputs = [(i // 2, name, units, content, f"s{i % 3}") for i, name, content, units in sample(2, 200)]
    catalog += catalog[:20]
    found = fuzzy_match(
        spark.createDataFrame(catalog, CATALOG), spark.createDataFrame(inputs, INPUT),
        cell_rows=cell_rows,
    )
    assert found.columns == list(RESULT_COLUMNS)
    expected = brute_force(catalog, inputs)
    assert len(expected) > 100
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_hot_unit_value(spark):
    """One unit pair holds everything, and a third of both sides is one row."""
    catalog = [("hot", "Cola light", "0,5", "6")] * 40 + [(f"i{i}", f"Cola light {i}", "0,5 l", "6") for i in range(80)]
    inputs = [(i if i > 40 else 0, f"Cola lite {i if i > 40 else 0}", "6", "0.5", "s") for i in range(120)]
    found = fuzzy_match(
        spark.createDataFrame(catalog, CATALOG), spark.createDataFrame(inputs, INPUT), cell_rows=16
    )
    assert sorted(tuple(r) for r in found.collect()) == brute_force(catalog, inputs)


def test_many_words_in_both_fields(spark):
    """A row has a key for each of its words and one more, whatever the other field holds."""
    units = " ".join(f"u{i}" for i in range(1_000))
    content = " ".join(f"c{i}" for i in range(1_000))
    catalog = [("i1", "Pils Kiste", content, units), ("i2", "Pils Kiste", "c5", "u7"), ("i3", "Pils Kiste", "c5 d", "u7")]
    inputs = [(1, "Pils Kisten", "u7", "c5", None), (2, "Pils Kiste", units, content, None), (3, "Pils", "u9 u7", content, None)]
    c, q = spark.createDataFrame(catalog, CATALOG), spark.createDataFrame(inputs, INPUT)
    assert sorted(map(str, (tuple(r) for r in fuzzy_match(c, q).collect()))) == sorted(map(str, brute_force(catalog, inputs)))
    entries = fuzzy._entries(q, "name", "no_of_base_units", "base_unit_content")
    counts, _ = fuzzy._met(entries, entries, "content_words")
    keys = fuzzy._keyed(entries, "content_words", counts, "q").groupBy("id").count()
    assert sorted(r["count"] for r in keys.collect()) == [2, 1_001, 1_001]


@pytest.mark.parametrize("block_pairs", [1 << 18, 3_000, 50])
@pytest.mark.parametrize("min_ratio", [70, 90])
def test_cell_of_many_rows_of_like_length(min_ratio, block_pairs):
    """Long and short stretches, names with more distinct characters than a signature has bits."""
    rng = random.Random(10)
    alphabet = "abcdefghijklmnopqrstuvwxyz0123456789" + "".join(chr(0x400 + i) for i in range(60)) + "𝄞"

    def side(first: int):
        names = ["".join(rng.choice(alphabet[: rng.choice([12, 97])]) for _ in range(rng.choice([0, 12, 12, 13]))) for _ in range(130)]
        names += [f"shared {i % 9} {'ab' * (i % 3)}" for i in range(40)]
        keys = ["one" if i < 120 else f"k{i % 4}" for i in range(len(names))]
        return pd.DataFrame({"id": range(first, first + len(names)), "key": keys, "name": names, "units_bits": 1, "content_bits": 2})

    class Counter:
        pairs = 0

        def add(self, n):
            self.pairs += n

    left, right, compared = side(0), side(1_000), Counter()
    found = fuzzy.similar_in_cell(min_ratio, compared, block_pairs)(left, right)
    pairs = [(a, b) for a in left.itertuples() for b in right.itertuples() if a.key == b.key]
    expected = {(a.id, b.id, plain_ratio(a.name, b.name)) for a, b in pairs}
    expected = {x for x in expected if x[2] >= min_ratio}
    assert len(found) == len(expected) and set(found.itertuples(index=False, name=None)) == expected
    assert compared.pairs < 0.3 * len(pairs)


def test_few_pairs_are_compared(spark):
    """All rows have one unit; their names share letters, but only copies match."""
    rng = random.Random(9)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(rng.randint(8, 60))) for _ in range(400)]
    catalog = [(f"i{i}", name, "0,5", "6") for i, name in enumerate(names)]
    inputs = [(i, name[:4] + "#" + name[5:], "6", "0,5", None) for i, name in enumerate(names)]
    c, q = spark.createDataFrame(catalog, CATALOG), spark.createDataFrame(inputs, INPUT)
    for min_ratio, share in ((70, 0.55), (90, 0.2)):
        compared = spark.sparkContext.accumulator(0)
        found = fuzzy_match(c, q, min_ratio, compared=compared)
        same = {(r["Golden_record"], r["gfgh_id"]) for r in found.collect()}
        assert same <= {(f"i{i}", i) for i in range(400)} and len(same) > 300
        assert compared.value < share * 400 * 400


@pytest.mark.parametrize("min_ratio", [0, 1, 40, 95, 100])
def test_other_minima(spark, min_ratio):
    catalog = [(f"i{i}", name, content, units) for i, name, content, units in sample(5, 40)] + [("e", "", "1", "6")]
    inputs = [(i, name, units, content, None) for i, name, content, units in sample(6, 40)] + [(99, "", "6", "1", None)]
    found = fuzzy_match(spark.createDataFrame(catalog, CATALOG), spark.createDataFrame(inputs, INPUT), min_ratio)
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, brute_force(catalog, inputs, min_ratio)))


def test_more_inputs_than_catalogue_rows(spark):
    catalog = [("i", "Pils Kiste", "0,5", "20")]
    inputs = [(i, "Pils Kiste", "20", "0,5", None) for i in range(130)]
    found = fuzzy_match(spark.createDataFrame(catalog, CATALOG), spark.createDataFrame(inputs, INPUT))
    assert found.count() == 130


def test_names_are_not_crossed(spark):
    """No join without an equality: hot keys stay splittable."""
    catalog = spark.createDataFrame([("i", "Pils", "0,5", "20")], CATALOG)
    inputs = spark.createDataFrame([(1, "Pils", "20", "0,5", None)], INPUT)
    plan = fuzzy_match(catalog, inputs)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_job(spark):
    skus = spark.createDataFrame(
        [("1", "Pils", "Brau", "20", "0,5", "0,5 l", 20), ("2", None, None, None, None, "0,5", 20)],
        "identifier string, title string, brand string, amount_single_unit string, net_content_liter string, "
        "base_unit_content string, no_of_base_units int",
    )
    assert {r["identifier"]: r["name"] for r in records(edit_catalog(skus))} == {"1": "Pils Brau 20x0,5", "2": "  x"}
    inputs = spark.createDataFrame([(5, "Pils Brau 20x0.5", "20", "0.5", "Kasten")], INPUT)
    (row,) = records(match_by_edit_ratio(skus, inputs))
    assert row["Golden_record"] == "1" and row["name_similarity"] == 94
    assert row["structure_packaging_unit_gfgh"] == "Kasten"
