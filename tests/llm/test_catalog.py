"""The registered queries: names, and those with SQL against DuckDB (sf0.001)."""
import re

import pytest
import oracle_check
import __spark_entry__ as E

from vehiscope.llm import catalog

from .conftest import SF


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in catalog.queries()) == list(range(1, 14))
    assert set(catalog.queries()) | {"pipeline"} <= set(E.queries())
    assert set(catalog.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, key):
    res = oracle_check.compare(spark, oracle_check.duck(SF), key, catalog.queries()[key], catalog.oracle_sql()[key], SF)
    assert res[1] == "ok", res
