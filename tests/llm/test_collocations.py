from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from llm import collocations as mining


def by_hand(rows: list[tuple], least: int, first: int) -> list[tuple]:
    """Phrases by their definition, with Python's whole numbers."""
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                own.update(tuple(words[at : at + n]) for at in range(len(words) - n + 1))
    found = []
    for lang, own in counts.items():
        total = sum(f for phrase, f in own.items() if len(phrase) == 1)
        candidates = {phrase: a for phrase, a in own.items() if len(phrase) > 1 and a >= least}
        ranked = []
        for phrase, a in candidates.items():
            longer = [f for p, f in candidates.items() if len(p) == 3 and phrase in (p[:2], p[1:])]
            if len(phrase) == 2 and any(100 * f >= 50 * a for f in longer):
                continue
            cuts = [(1_000_000 * a * a // (own[phrase[:k]] * own[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(phrase).encode(), a, own[phrase[:k]], own[phrase[k:]], score))
        for rank, (_, _, phrase, a, left, right, score) in enumerate(sorted(ranked)[:first], 1):
            found.append((lang, rank, phrase.decode(), a, left, right, total, score))
    return sorted(found)


def mined(df, **options) -> list[tuple]:
    return sorted(tuple(row) for row in mining.collocations(df, **options).collect())


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    draw = random.Random(5)
    words = ["New", "york", "CITY", "des", "É", "é", "中文", "\x00", "a-b", "x#", "naïve"]
    rows: list[tuple] = [(None, None), ("de", ""), ("und", " \t\n"), ("fr", "one two"), ("long", "tie " * 5000)]
    for _ in range(120):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", ", ", ". ", "\n", "  ", "!?"]) for _ in range(60))
        rows.append((draw.choice(["en", "de", None, "und", ""]), text))
    return [*rows, *rows[5:15]]


def test_equals_counting_by_hand(spark, rows):
    df = spark.createDataFrame([(*row, 7, "x", 1) for row in rows], "lang string, text string, block long, word string, n int")
    wanted = by_hand(rows, 10, 40)
    assert mined(df.repartition(5), first=40) == wanted
    # Many small ranges and blocks give the same.
    assert mined(df.repartition(9), first=40, size=50) == wanted


def test_small_blocks_and_a_language_with_most_phrases(spark, rows, monkeypatch):
    monkeypatch.setattr(mining, "SALTS", 3)
    every = [("en", text) for _, text in rows]
    df = spark.createDataFrame(every, "lang string, text string").repartition(20)
    assert mined(df, least=3, first=25) == by_hand(every, 3, 25)


def test_empty_tables(spark, nothing):
    from pyspark.sql import functions as F

    assert mined(nothing.withColumn("lang", F.lit("en"))) == []
    assert mined(spark.createDataFrame([("en", "only once said")], "lang string, text string")) == []


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 13), (2, 32), (3, 2), (3, 7), (3, 21), (3, 22), (3, 32)])
def test_filters_hold_their_ngrams_and_counts(n, bits):
    draw = np.random.default_rng(n * 100 + bits)
    layout = mining.Layout(n, bits, 3)
    words = [draw.integers(0, 1 << bits, 5000) for _ in range(n)]
    words = [np.concatenate([w, w[:700], w[:300]]) for w in words]
    left, right = layout.of(words)
    assert (left < 1 << layout.half).all() and (right < 1 << layout.half).all()
    assert all((a == b).all() for a, b in zip(layout.words(left, right), words))
    found = Counter()
    for _, own, size, runs, low, right_, high, counts in mining._filter_rows(1, left, right, layout):
        halves = mining.opened(own, runs, low, right_, high, layout)
        assert len(halves[0]) == size
        back = zip(*(part.tolist() for part in layout.words(*halves)))
        found.update(dict(zip(back, mining.unpacked(counts).tolist())))
    assert found == Counter(zip(*(w.tolist() for w in words)))


def test_permutation_spreads_alike_ngrams():
    """Neighbouring numbers fall into all ranges about equally."""
    layout = mining.Layout(2, 20, 6)
    ids = np.arange(1, 40_001)
    left, _ = layout.of([np.full(40_000, 1), ids])
    shares = np.bincount((left >> np.uint64(layout.half - 6)).astype(int), minlength=64) / 40_000
    assert shares.max() < 1.3 / 64 and shares.min() > 0.7 / 64


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    rows = [(9 * 10**12, 9 * 10**12, 10**13 + 1), (3 * 10**12, 10**17, 3 * 10**12), (10, 10, 10)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    found = df.select("a", "l", "r", mining._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [row.s for row in found] == [1_000_000 * a * a // (left * right) for a, left, right in rows]
