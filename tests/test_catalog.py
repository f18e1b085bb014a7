"""Every registered query against its SQL at the smallest scale."""

import pytest
from check import compare, connect

import __spark_entry__
from recensio import catalog

SF_DIR = "/root/testdata/sf0.001"
SLOW = {"m17_feature_importance"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in catalog.queries() if n not in SLOW])
def test_query(spark, con, name):
    state, rows, _, _, note = compare(spark, con, SF_DIR, name)
    assert state in ("ok", "rows"), note
    assert rows > 0 or state == "ok"


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["label", "n"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
