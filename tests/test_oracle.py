"""Every registered query against its DuckDB oracle (the driver's check), at sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tools.compare import compare

NAMES = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res
