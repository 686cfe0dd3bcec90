"""Every registered query with SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tools.check import check, open_tables

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_its_sql(spark, tables, name):
    rows, verdict = check(spark, tables, SF_DIR, name)
    assert verdict == "ok" and rows > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["doc_id", "predicted"]
    assert result.count() == 200
