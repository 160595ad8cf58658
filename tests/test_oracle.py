"""Every registered query against its SQL statement in DuckDB (sf0.001).

The same comparison the driver runs at sf0.01: row count, column names and
order-insensitive values. Entries without SQL must at least run.
"""
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import oracle_check  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from vehiscope.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF)


FORBIDDEN = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "PythonUDF")


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    """Same rows as the SQL; and the plan has no cross/nested-loop join and
    no Python evaluation."""
    sdf = E.queries()[key](spark, SF)
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], key
    res = oracle_check.compare(spark, con, key, None, E.oracle_sql()[key], SF, sdf=sdf)
    assert res[1] == "ok", res


def test_every_query_has_sql():
    assert set(KEYS) <= set(E.queries())
    assert set(KEYS) == set(catalog.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["make", "total_complaints", "crash_incidents", "fire_incidents",
                          "vehicle_count", "complaints_per_vehicle"]
    assert len(rows) > 0
