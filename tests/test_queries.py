"""Every registered query against its SQL oracle."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, require_same

FOLDER = "/root/testdata/sf0.01"
# The training-data operators, if they are there, have their own tests.
OWN = sorted(name for name in queries() if not name.startswith("op") and name != "pipeline")


@pytest.fixture(scope="module")
def db():
    with connect(FOLDER) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_oracle(spark, db, name):
    assert require_same(queries()[name](spark, FOLDER), db, oracle_sql()[name]) > 0


def test_entry_runs(spark):
    assert entry(spark).count() > 0
