from __future__ import annotations

import pytest
from comparing import by_key

from skuweave.operators.translate import (
    fits_broadcast,
    option_values,
    translate_codes,
    unique_lookup,
)

OPTIONS = [(1, "l05"), (2, "u1"), (3, "u2"), (4, "empty"), (5, None)]
VALUES = [(1, "0,5"), (2, "u2"), (3, "litre"), (3, "zzz"), (9, "orphan"), (5, "no code")]
ROWS = [
    ("a", "l05", "u1", "u1"),
    ("b", "unknown", "u2", None),
    ("c", None, None, "empty"),
    ("d", "l05", "l05", "u2"),
]


@pytest.fixture
def frames(spark):
    options = spark.createDataFrame(OPTIONS, "id long, code string")
    values = spark.createDataFrame(VALUES, "option_id long, value string")
    rows = spark.createDataFrame(ROWS, "id string, x string, twice string, once string")
    return rows, unique_lookup(option_values(options, values))


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_passes(frames, broadcast):
    rows, lookup = frames
    done = translate_codes(rows, lookup, {"x": 1, "twice": 2, "once": 1}, broadcast=broadcast)
    assert done.columns == rows.columns
    found = by_key(done, "id")
    assert len(found) == done.count() == 4
    assert found["a"] == {"id": "a", "x": "0,5", "twice": "litre", "once": "u2"}
    assert found["b"] == {"id": "b", "x": "unknown", "twice": "litre", "once": None}
    assert found["c"] == {"id": "c", "x": None, "twice": None, "once": "empty"}
    assert found["d"] == {"id": "d", "x": "0,5", "twice": "0,5", "once": "litre"}


def test_size_decides(frames):
    rows, lookup = frames
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, rows=2)
    assert not fits_broadcast(lookup, characters=3)


def test_both_forms_agree_on_repeated_and_null_keys(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "x"), (None, None)], "key string, code string")
    lookup = spark.createDataFrame([("x", "X"), ("y", "Y")], "code string, value string")
    for settings in ({"broadcast": True}, {"broadcast": False}, {"rows": 0}):
        done = translate_codes(rows, lookup, {"code": 1}, **settings)
        assert sorted(map(tuple, done.collect()), key=str) == sorted(
            [("a", "X"), ("a", "Y"), (None, "X"), (None, None)], key=str
        )


def test_broadcast_moves_no_rows(frames):
    rows, lookup = frames
    plan = translate_codes(rows, lookup, {"x": 1, "once": 1}, broadcast=True)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin [x" not in plan
