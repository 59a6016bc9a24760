from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from prose_texts import prose  # noqa: E402

ODD_COLUMNS = (
    "doc_id long, text string, id long, key string, block int, node int, ids string, sig int, "
    "label int, words int, n int, spans string, row int, blob string"
)


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """Null ids and texts, blank, repeated, tied, long and non-ASCII texts."""
    base = prose(60, 1)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one two"),
        (5, base),
        (5, base),
        (6, base),
        (7, base.replace("the", "THE", 3)),
        (8, prose(40, 2)),
        (8, prose(40, 3)),
        (None, base),
        (None, prose(30, 4)),
        (9, "É" * 50 + " naïve 中文 😀 " + prose(20, 5)),
        (10, prose(30_000, 6)),
        (11, "x" * 100_000),
        (12, "tie tie tie tie tie tie tie tie tie tie tie tie"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows above with further columns whose names operators use themselves."""
    width = ODD_COLUMNS.count(",") - 1
    return spark.createDataFrame([(*row, *[None] * width) for row in odd_rows], ODD_COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
