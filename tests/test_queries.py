"""Every query with SQL against that SQL, over the smallest tables; the others for their schema."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, of_spark, of_sql

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert of_spark(entry.queries()[name](spark, ROOT)) == of_sql(connect(ROOT), entry.oracle_sql()[name])


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "xml"] and df.count() > 0
