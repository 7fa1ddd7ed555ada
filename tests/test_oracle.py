"""Every query against the checking SQL on the sample tables."""

import datetime as dt
import os

import duckdb
import pytest

from __spark_entry__ import entry
from visitrec.standins.queries import QUERIES
from visitrec.standins.sql import ORACLE_SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


def _value(value):
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        [tuple(_value(row[i]) for i in order) for row in rows],
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(names)
    expected = _rows(names, cursor.fetchall())
    actual = _rows(result.columns, [tuple(row) for row in result.collect()])
    assert expected, "an empty result checks nothing"
    assert len(actual) == len(expected)
    assert actual == expected


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["newest_row", "freshness"])
def test_newest_is_a_top_one(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"matched_local", "matched_registry", "id_list"}))
def test_no_sort_of_all_rows_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for banned in ("rangepartitioning", "SinglePartition", "Cartesian", "NestedLoop", "EvalPython", "Window"):
        if banned == "SinglePartition" and name in ("reconcile_status_counts", "registry_discrepancy"):
            continue  # the last step of a global count: one row per task
        assert banned not in plan


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 4 and all(row.n_rows > 0 for row in rows)
