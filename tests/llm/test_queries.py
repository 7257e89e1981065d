"""Registered queries of the text operators against their SQL."""

import pytest

from gridloom.llm import registry
from tests.oracle import same, tables

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, name):
    same(registry.queries()[name](spark, SF), tables(SF).sql(registry.oracle_sql()[name]))


def test_all_ten_are_there():
    import __spark_entry__ as e

    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in e.queries()} and "pipeline" in e.queries()
