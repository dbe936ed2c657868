from __future__ import annotations

import os
import re

import pytest
from conftest import SMOKE

import __spark_entry__ as contract
from checks.compare import connect, differences

# The driver compares at sf0.01; here the smallest data keeps the suite short.
SF_DIR = os.environ.get("TESORA_SF_DIR", SMOKE)
# Operators for training data have their own tests.
QUERIES, SQL = ({k: v for k, v in found().items() if not re.match(r"op\d|pipeline", k)} for found in (contract.queries, contract.oracle_sql))


@pytest.fixture(scope="module")
def engine():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql_and_a_plain_name():
    assert QUERIES and set(QUERIES) == set(SQL)


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "nivel_alerta_cliente" in df.columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, engine, name):
    assert differences(QUERIES[name](spark, SF_DIR), engine, SQL[name]) == []


def test_no_query_joins_without_keys(spark):
    for name in ("mart_cliente_360", "kpi_resumen", "audit_orphans", "quarantine_all", "silver_movimientos", "report_gold_counts"):
        plan = QUERIES[name](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan, name
