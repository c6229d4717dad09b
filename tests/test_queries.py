"""Every registered query of the engine's own operators against its SQL."""

import pytest

from lensgrove.plans.queries import ORACLES, QUERIES

from .oracle import assert_same

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert_same(QUERIES[name](spark, FOLDER), ORACLES[name], FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
