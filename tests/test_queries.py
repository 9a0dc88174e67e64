"""Every named query against its SQL, on the smallest tables."""

import sys

import pytest

import __spark_entry__ as entry
from shopstream.plans import catalog, oracles

sys.path.insert(0, "tools")
from tools import check  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_matches_sql(spark, con, name):
    result = check.compare(spark, con, SF, name)
    assert result.startswith("ok") and "types" not in result, result


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracles.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["dt", "province_name", "order_count"]
    assert df.count() > 0
