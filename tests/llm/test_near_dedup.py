from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm.near_dedup import Likeness, components, group_near, least_matches, signatures


def brute(texts: dict[int, str | None]) -> dict[int, tuple[int, int, bool]]:
    sets, holders, root = {}, defaultdict(list), {key: key for key in texts}
    for key, text in texts.items():
        words = (text or "").encode().lower().split()
        every = {tuple(words[at : at + 5]) for at in range(len(words) - 4)}
        sets[key] = every or ({tuple(words)} if words else set())
        for shingle in sets[key]:
            holders[shingle].append(key)

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    for key, own in sets.items():
        for other, both in Counter(o for s in own for o in holders[s] if o < key).items():
            if 100 * both >= 75 * (len(own) + len(sets[other]) - both):
                a, b = sorted((find(key), find(other)))
                root[b] = a
    return {key: (len(sets[key]), find(key), find(key) == key) for key in texts}


def found(df) -> dict[int, tuple[int, int, bool]]:
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in group_near(df).collect()}


@pytest.mark.parametrize("seed", [3, 4])
def test_groups_as_brute_force(spark, seed):
    draw = random.Random(seed)
    words = [f"w{at}" for at in range(3_000)]
    rows: list[tuple[int, str | None]] = []
    for _ in range(40):
        base = [draw.choice(words) for _ in range(draw.randint(3, 120))]
        for _ in range(draw.randint(1, 25)):
            own = list(base)
            for _ in range(draw.randint(0, max(1, len(own) // 25))):
                own[draw.randrange(len(own))] = draw.choice(words)
            own = own[: max(1, int(len(own) * draw.uniform(0.75, 1)))]
            rows.append((len(rows), " ".join(own).title() if draw.random() < 0.3 else "\n".join(own)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "one two"), (len(rows) + 3, "One  TWO")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(dict(rows))


def test_a_large_group_of_near_copies_is_one_component(spark):
    draw = random.Random(7)
    words = [f"w{at}" for at in range(2_000)]
    base = [draw.choice(words) for _ in range(100)]
    rows = []
    for key in range(600):
        own = list(base)
        own[draw.randrange(100)] = draw.choice(words)
        rows.append((key, " ".join(own)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(dict(rows))


def test_buckets_larger_than_a_cell(spark):
    draw = random.Random(9)
    words = [f"w{at}" for at in range(2_000)]
    base = [draw.choice(words) for _ in range(80)]
    rows = []
    for key in range(150):
        own = list(base)
        for _ in range(draw.randint(0, 6)):
            own[draw.randrange(80)] = draw.choice(words)
        rows.append((key, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in group_near(df, Likeness(cell=10)).collect()}
    assert got == brute(dict(rows)) == found(df)


def test_odd_rows(odd, nothing):
    rows = group_near(odd).collect()
    assert len(rows) == odd.count()
    by_id = defaultdict(list)
    for row in rows:
        by_id[row["doc_id"]].append(row)
    for blank in (1, 2, 3):
        assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in by_id[blank]] == [(0, blank, True)]
    assert [(r["component_id"], r["kept"]) for r in by_id[5]] == [(5, True)] * 2
    assert {r["component_id"] for key in (5, 6, 7) for r in by_id[key]} == {5}
    assert {r["component_id"] for r in by_id[8]} == {8}
    assert sorted((r["component_id"] or -1, r["kept"]) for r in by_id[None]) == [(-1, False), (5, False)]
    assert by_id[4][0]["n_shingles"] == 1
    assert group_near(nothing).count() == 0


def test_bounds_of_matches():
    how = Likeness()
    limits = least_matches(how)
    assert limits[-1][0] == how.hashes
    assert all(needed < 0.75 * seen for seen, needed in limits)
    draw = np.random.default_rng(1)
    sets, shares = [], []
    for _ in range(200):
        every = draw.integers(0, 1 << 63, 70, np.uint64)
        sets += [np.sort(every[:60]), np.sort(every[10:])]
    for left, right in zip(sets[::2], sets[1::2]):
        a, b = signatures([left, right], how.hashes, how.seed)
        shares.append((a == b).mean())
    assert abs(np.mean(shares) - 50 / 70) < 0.01


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(at, at + 1) for at in range(60)] + [(100, 99)], "a long, b long")
    labels = {r["node"]: r["label"] for r in components(edges).collect()}
    assert labels == {at: 0 for at in range(61)} | {99: 99, 100: 99}
