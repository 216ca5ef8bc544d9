"""Every query against its SQL, over whole test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp", "BOOLEAN": "boolean"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got = driver.queries()[name](spark, SF_DIR)
    expect = db.sql(driver.oracle_sql()[name])
    kinds = dict(zip(expect.columns, (KINDS[str(t)] for t in expect.types)))
    assert dict(got.dtypes) == kinds
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(expect.columns, expect.fetchall())


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_model_query_is_sane(spark, name):
    result = driver.queries()[name](spark, SF_DIR).collect()
    assert result
    for row in result:
        for key, value in row.asDict().items():
            if key in ("auc", "acc", "precision", "recall", "f1", "importance"):
                assert 0 <= value <= 1 and not math.isnan(value)


def test_entry(spark):
    assert driver.entry(spark).columns == ["month", "total_orders", "total_revenue"]
    assert set(driver.oracle_sql()) <= set(driver.queries())
