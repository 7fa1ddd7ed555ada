"""Queries of the text operators that have SQL, against it."""

import duckdb
import pytest

from visitrec.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([row[i] for i in order] for row in values), key=lambda row: [(v is not None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, name):
    result = QUERIES[name](spark, SF)
    connection = duckdb.connect()
    for table in ("documents", "conversations", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = connection.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    expected = rows(names, cursor.fetchall())
    assert sorted(names) == sorted(result.columns) and expected
    assert rows(result.columns, [tuple(r) for r in result.collect()]) == expected
