"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalogue.queries import all_queries
from tools.compare import difference, duck

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return duck(FOLDER)


def test_every_query_of_the_catalogue_has_sql():
    assert set(all_queries()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query_equals_sql(spark, db, key):
    df = queries()[key](spark, FOLDER)
    result = db.execute(oracle_sql()[key])
    names = [column[0] for column in result.description]
    assert difference(df.columns, df.collect(), names, result.fetchall()) is None


def test_entry(spark):
    assert entry(spark).count() > 0
