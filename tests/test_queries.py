"""Every registered query against its SQL twin, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from workload.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert difference(got, duck.execute(ORACLES[name]).df()) == ""
