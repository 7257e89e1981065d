"""Every registered query of the grid and graph operators against its SQL, on the smallest tables."""

import pytest

from gridloom.plans import registry
from tests.oracle import same, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return tables(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, sql, name):
    same(registry.queries()[name](spark, SF), sql.sql(registry.oracle_sql()[name]))


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(registry.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_body_matching(spark):
    got = registry.body_matching(spark, SF).collect()
    segs = [r["seg"] for r in got if r["seg"]]
    assert len(got) == 25 and len(set(segs)) == len(segs) > 0
