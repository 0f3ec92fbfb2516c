"""Every registered query against its DuckDB oracle at sf0.01 (the
driver's correctness gate), plus the smoke entry."""

import pytest

import __spark_entry__ as E
from conftest import SF01
from parity import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "Rolling_std_30_value" in df.columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, con, name):
    r = compare(spark, name, SF01, con)
    assert r["rows"][0] == r["rows"][1] and r["cols"] and r["types"], r
    assert r["hash"], r
