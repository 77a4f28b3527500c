"""Every registered query against its SQL, at the smallest scale or ``TEST_SF_DIR``."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalogue import ORACLES, QUERIES
from tests.compare import assert_same, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    got = queries()[name](spark, SF_DIR).toArrow()
    want = oracle(SF_DIR, oracle_sql()[name])
    assert_same(got, want)
    assert got.num_rows > 0


def test_entry_runs(spark):
    assert entry(spark).limit(1).count() == 1


def test_a_query_leaves_no_view_in_the_session(spark):
    before = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    assert QUERIES["transform_chain"](spark, SF_DIR).count() > 0
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} == before
