"""Every catalog query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry
from tapeflow.plans.catalog import QUERIES
from tapeflow.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    return connection


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(repr, frame.astype(object).where(frame.notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    table = QUERIES[name](spark, SF_DIR)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = table.toPandas()
    assert len(got)
    if name in ORACLE:
        want = database.execute(ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
