"""The Bloom filter before wide pulls: nothing listed is lost, little else passes, what is broadcast is bounded."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from visitrec.operators import requested_only, sieve, sieve_blocks
from visitrec.operators.sieve import BLOCK_BITS, MOST_BLOCKS


@pytest.mark.parametrize("kind", ["bigint", "string", "date"])
def test_lets_listed_through_and_little_else(spark, kind):
    def keyed(df):
        key = F.date_add(F.lit(dt.date(1970, 1, 1)), F.col("id").cast("int")) if kind == "date" else F.col("id").cast(kind)
        return df.select(key.alias("a.id"), F.repeat(F.lit("w"), 50).alias("wide"))

    records = keyed(spark.range(0, 60_000, 1, 4)).union(keyed(spark.range(0, 600)))
    listed = keyed(spark.range(0, 60_000, 30)).drop("wide")
    passed = sieve(records, listed, "a.id", 2000)
    assert passed.columns == records.columns
    wanted = requested_only(records, listed, "a.id")
    assert wanted.exceptAll(passed).isEmpty()
    assert 2020 <= passed.count() < 2020 + 60_000 // 100
    exact = requested_only(passed, listed, "a.id")
    assert exact.exceptAll(wanted).isEmpty() and wanted.exceptAll(exact).isEmpty()


def test_too_small_a_filter_loses_nothing(spark):
    records, listed = spark.range(5000), spark.range(0, 5000, 2)
    passed = sieve(records, listed, "id", 1)
    assert listed.exceptAll(passed).isEmpty()


def test_nulls_and_empty_sides(spark):
    records = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), (None, 4)], "k string, n int")
    for ids, expected in (([("a",), (None,)], [1, 2, 4]), ([], [])):
        listed = spark.createDataFrame(ids, "k string")
        assert sorted(r.n for r in sieve(records, listed, "k", len(ids)).collect()) == expected
    assert sieve(records.limit(0), records, "k", 3).isEmpty()


def test_sides_of_different_types_pass_whole(spark):
    records = spark.range(10)
    for listed in (records.select(F.col("id").cast("string")), records.select(F.col("id").cast("int"))):
        assert sieve(records, listed, "id", 10).count() == 10
    doubles = records.select(F.col("id").cast("double"))
    assert sieve(doubles, doubles.limit(1), "id", 1).count() == 10


def test_size_is_bounded():
    assert sieve_blocks(0) == sieve_blocks(1) == 1
    sizes = [sieve_blocks(n) for n in (10**3, 10**5, 10**6, 10**7, 10**9)]
    assert sizes[:3] == [1, 64, 512] and sizes[3] == MOST_BLOCKS and sizes[4] == 0
    assert MOST_BLOCKS * BLOCK_BITS // 8 == 8 << 20


def test_plan_has_no_shuffle_of_the_records(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "r"))
    records = spark.read.parquet(str(tmp_path / "r"))
    plan = sieve(records, spark.range(10), "id", 10)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in above and "FileScan" in above and "Exchange hashpartitioning" not in above
