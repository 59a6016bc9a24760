from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
import comparing

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver tables")


@pytest.fixture(scope="module")
def db():
    return comparing.database(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_sql(spark, db, name):
    problems = comparing.compare(spark, FOLDER, contract.queries()[name], contract.oracle_sql()[name], db)
    assert problems == []


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
