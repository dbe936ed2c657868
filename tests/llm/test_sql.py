"""Registered queries against their SQL on the smallest tables; operators 10, 12 and 13 have this in their own tests."""

from __future__ import annotations

import pytest

from checks.compare import connect, differences
from tesora.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op7_minhash_components", "op9_fm_index"])
def test_query_equals_its_sql(spark, name):
    assert differences(queries.queries()[name](spark, SMALL), connect(SMALL), queries.oracle_sql()[name]) == []


def test_every_sql_belongs_to_a_query():
    assert set(queries.oracle_sql()) <= set(queries.queries())
