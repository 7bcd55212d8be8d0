"""The registered queries: agreement of their names and results with the SQL."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402

def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "customer_id" and df.count() > 0


@pytest.fixture(scope="module")
def con(folder):
    return check_queries.duck(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, con, folder, name):
    ok, note = check_queries.compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], folder)
    assert ok, note
    assert "types differ" not in note, note
