"""Every registered query gives what its SQL gives."""

import pytest

import __spark_entry__ as entry
from millrace.catalog import load_all
from tests.oracle import compare, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_sql():
    assert set(load_all().QUERIES) == set(load_all().SQL)
    assert set(load_all().QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(load_all().QUERIES))
def test_query(spark, con, name):
    good, note = compare(spark, con, name, SF)
    assert good, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["conv_id", "n_tokens", "n_supervised", "share"]
    assert df.count() > 0
