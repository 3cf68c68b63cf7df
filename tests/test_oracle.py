"""Every registered query against its DuckDB oracle on the smallest data set
(the driver runs the same comparison at sf0.01)."""

import pytest

from forumlens.plans.oracle_check import compare, duck_connect
from forumlens.plans.registry import entries

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(entries()))
def test_query_matches_oracle(spark, con, name):
    e = entries()[name]
    r = compare(spark, con, name, e.fn, e.sql, SF_SMALL)
    assert r["status"] in ("ok", "rows-only"), r
