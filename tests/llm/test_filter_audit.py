from __future__ import annotations

import itertools
import random

import pytest

from llm import filter_audit
from prose_texts import prose


def by_hand(rows: list[tuple], labels: list[tuple]) -> dict:
    """Every order applied filter by filter to every document."""
    lows: dict = {}
    for id_, text, _ in rows:
        if id_ is not None:
            lows[text or ""] = min(id_, lows.get(text or "", id_))
    docs = []
    for id_, text, part in rows:
        text = text or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": id_ is not None and lows[text] < id_,
        }
        good = any(a == id_ and q == 1 for a, q, _ in labels if a is not None)
        toxic = any(a == id_ and t == 1 for a, _, t in labels if a is not None)
        docs.append((part or "", fails, good, toxic))
    found: dict = {}
    for part in {doc[0] for doc in docs}:
        mine = [doc for doc in docs if doc[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [doc for doc in left if doc[1][letter]]
                left = [doc for doc in left if not doc[1][letter]]
                shapley[letter] += len(gone)
                failing = sum(doc[1][letter] for doc in mine)
                alone = sum(doc[1][letter] and sum(doc[1].values()) == 1 for doc in mine)
                found[part, order, step] = [
                    len(left), len(gone), failing - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone),
                ]
        for (own, order, step), values in found.items():
            if own == part:
                values.append(shapley[order[step - 1]])
    return found


def result(df) -> dict:
    return {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in df.collect()
    }


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("rounds", [4])
def test_equals_every_order_by_hand(spark, odd_rows, tmp_path, rounds):
    """Copies whose smaller id comes in a later file take their earlier masks back."""
    draw = random.Random(3)
    texts = [prose(80, 11), prose(60, 12).upper(), "short", "tie " * 70, prose(55, 13) + " 5 % & more", "", None]
    rows = [(id_, text, None) for id_, text in odd_rows]
    rows += [(draw.randrange(60), draw.choice(texts), draw.choice(["a", "b", ""])) for _ in range(150)]
    labels = [(n, draw.randrange(2), draw.randrange(2)) for n in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1), (6, None, None)]
    # Ids fall from file to file.
    rows.sort(key=lambda row: -(row[0] if row[0] is not None else 30))
    path = f"{tmp_path}/documents.parquet"
    for at in range(0, len(rows), 30):
        part = spark.createDataFrame([(*row, "x", 1) for row in rows[at : at + 30]], "doc_id long, text string, source string, key string, n int")
        part.coalesce(1).write.mode("append").parquet(path)
    given = spark.createDataFrame(labels, LABELS)
    found = result(filter_audit.interactions(filter_audit.mask_counts(spark, path, given, rounds=rounds)))
    assert found == by_hand(rows, labels)


def test_empty_table_and_later_files(spark, tmp_path):
    path, folder = f"{tmp_path}/documents.parquet", f"{tmp_path}/state"
    kind = "doc_id long, text string, source string"
    labels = spark.createDataFrame([], LABELS)
    spark.createDataFrame([], kind).write.parquet(path)
    assert filter_audit.mask_counts(spark, path, labels).count() == 0
    first, later = [(9, "same", "a"), (8, "other", "a")], [(3, "same", "b"), (10, "same", "b"), (9, "same", "b")]
    for rows in (first, later):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(path)
        counts = filter_audit.mask_counts(spark, path, labels, folder=folder, buckets=3)
        wanted = first if rows is first else first + later
        assert result(filter_audit.interactions(counts)) == by_hand(wanted, [])


def test_revise_takes_back_what_larger_ids_held():
    low, held, deltas = filter_audit.revise(7, {("a", 1): 2}, [("b", [3, 0, 1, 5, 1, 4, 2])])
    assert (low, held) == (5, {("b", 0): 1})
    assert deltas == {("a", 3, 1): -2, ("a", 19, 1): 2, ("b", 3, 0): 3, ("b", 19, 0): 4}
