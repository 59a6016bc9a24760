from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np

from llm.decontaminate import Index, Limits, find_leaks, parts_of, without_leaks, words_of


def items_of(count: int, seed: int) -> list[tuple[int, bytes]]:
    draw = random.Random(seed)
    common = ["the", "of", "and", "in", "to"]
    rare = [f"word{at}" for at in range(400)]
    made = []
    for key in range(count):
        words = [draw.choice(common if draw.random() < 0.4 else rare) for _ in range(draw.randint(8, 50))]
        made.append((key, (" ".join(words[:-6]) + ". " + " ".join(words[-6:]) + ".").encode()))
    return made


def index_of(items, limits=Limits()):
    split = [set(words_of(text)) for _, text in items]
    counts = Counter(word for words in split for word in words)
    lengths = [len(words_of(text)) for _, text in items]
    return Index(items, limits, counts, len(items), sum(lengths) / len(items)), counts, sum(lengths) / len(items)


def test_retrieval_is_exact():
    items = items_of(60, 1)
    limits = Limits(score=0.25)
    index, counts, average = index_of(items, limits)
    draw = random.Random(2)
    words = [draw.choice(["the", "of", "and", *[f"word{at}" for at in range(500)]]) for _ in range(3_000)]
    for _, text in items[:10]:
        at = draw.randrange(len(words))
        words[at:at] = words_of(text)[: draw.randint(4, 40)]
    every = [w.encode() if isinstance(w, str) else w for w in words]
    codes = np.array([index.terms.get(w, -1) for w in every])
    begins, ends = index.windows(np.array([len(every)]))
    got = {(w, index.items[i]): s for w, i, s in index.retrieve(codes, begins, ends)}
    want = {}
    for window, (begin, end) in enumerate(zip(begins, ends)):
        held = set(every[begin:end])
        for key, text in items:
            own = Counter(words_of(text))
            norm = limits.k1 * (1 - limits.b + limits.b * sum(own.values()) / average)
            part = {
                w: math.log(1 + (len(items) - counts[w] + 0.5) / (counts[w] + 0.5)) * n * (limits.k1 + 1) / (n + norm)
                for w, n in own.items()
            }
            score = sum(v for w, v in part.items() if w in held)
            if score >= limits.score * sum(part.values()):
                want[window, key] = score
    assert got.keys() == want.keys() and len(want) > 20
    assert all(math.isclose(got[k], want[k]) for k in want)


def test_windows_hold_every_item_and_the_whole_text():
    index, _, _ = index_of(items_of(5, 3))
    lengths = np.array([0, 1, index.stride, 2 * index.stride + 1, 1_000])
    begins, ends = index.windows(lengths)
    covered = np.zeros(lengths.sum(), bool)
    for begin, end in zip(begins, ends):
        covered[begin:end] = True
    assert covered.all()
    for start in range(1_000 - index.stride):
        first = lengths[:4].sum() + start
        assert any(b <= first and first + index.stride <= e for b, e in zip(begins, ends))


def test_leaks_are_found_and_clean_documents_stay(spark, odd, nothing):
    items = items_of(40, 5)
    draw = random.Random(6)
    filler = " ".join(draw.choice(["the", "of", *[f"plain{at}" for at in range(300)]]) for _ in range(400))
    nameless = " ".join(f"nameless{at}" for at in range(30))
    whole, half = items[3][1].decode(), " ".join(items[4][1].decode().split()[:-8])
    rows = [
        (1, filler),
        (2, f"{filler} {whole.upper()} {filler}"),
        (3, f"{filler} {half} {filler}"),
        (4, None),
        (5, whole),
        (5, whole),
        (None, whole),
        (6, f"{items[7][1].decode()}\n{filler}\n{items[8][1].decode()}"),
        (7, f"{filler} {nameless}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame(
        [(key, text.decode()) for key, text in items] + [(90, None), (91, ""), (None, items[9][1].decode()), (3, whole)],
        "item_id long, text string",
    )
    found = find_leaks(docs, tests).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in found) == Counter(
        {(2, 3): 1, (5, 3): 2, (None, 3): 1, (6, 7): 1, (6, 8): 1}
    )
    kept = without_leaks(docs, tests).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3, 4, 7]
    shards = find_leaks(docs, tests, Limits(shard=7)).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in shards) == Counter((r["doc_id"], r["item_id"]) for r in found)
    assert without_leaks(odd, tests).count() == odd.count()
    # An item without id leaks as well; only lists by id leave it out.
    unnamed = tests.union(spark.createDataFrame([(None, nameless)], tests.schema))
    assert sorted(r["doc_id"] for r in without_leaks(docs, unnamed).collect()) == [1, 3, 4]
    assert without_leaks(docs, tests.limit(0)).count() == len(rows)
    assert find_leaks(nothing, tests).count() == 0
    assert find_leaks(odd, tests.limit(0)).count() == 0


def test_question_and_answer():
    words, question = parts_of(b"Where is it now? It is on the hill.")
    assert len(words) == 9 and question == 4
    words, question = parts_of(b"one sentence of six words only")
    assert len(words) == 6 and question == 3
