"""Null-safe semi, anti, inner and tagged joins: rows, properties and plans."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.operators import (
    discrepancy,
    in_both,
    in_order,
    join_listed,
    id_list,
    key_batches,
    newest,
    no_keys,
    only_in,
    reconcile,
    requested_only,
    status_counts,
)

KEYS = ["a", "d", "v"]
SCHEMA = "a string, d date, v string, n int"

key = st.tuples(
    st.sampled_from(["p", "q", None]),
    st.sampled_from([dt.date(2020, 1, 1), dt.date(1970, 1, 1), None]),
    st.sampled_from(["001", "1", "", None]),
)


def frames(spark, left, right):
    number = lambda rows: [(*row, i) for i, row in enumerate(rows)]
    return spark.createDataFrame(number(left), SCHEMA), spark.createDataFrame(number(right), SCHEMA)


def ids(df):
    return sorted(row.n for row in df.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=st.lists(key, max_size=12), right=st.lists(key, max_size=12))
def test_against_brute_force(spark, left, right):
    l, r = frames(spark, left, right)
    alone = [i for i, k in enumerate(left) if k not in right]
    shared = [i for i, k in enumerate(left) if k in right]
    assert ids(only_in(l, r, KEYS)) == alone
    assert ids(in_both(l, r, KEYS)) == shared
    tagged_l, tagged_r = reconcile(l, r, KEYS)
    assert {row.n: row.status for row in tagged_l.collect()} == {
        i: "both" if k in right else "left_only" for i, k in enumerate(left)
    }
    assert {row.n: row.status for row in tagged_r.collect()} == {
        i: "both" if k in left else "right_only" for i, k in enumerate(right)
    }
    counts = {(row.side, row.status): row.n_rows for row in status_counts(l, r, KEYS).collect()}
    assert counts == {
        ("left", "left_only"): len(alone),
        ("left", "both"): len(shared),
        ("right", "right_only"): sum(k not in left for k in right),
        ("right", "both"): sum(k in left for k in right),
    }
    times = Counter(right)
    joined = Counter(row.n for row in join_listed(l, r, KEYS).collect())
    assert joined == Counter({i: times[k] for i, k in enumerate(left) if times[k]})


def test_matched_keys_agree(spark):
    l, r = frames(spark, [("p", None, "1"), ("p", None, "1"), ("q", None, None)], [("p", None, "1"), ("z", None, None)])
    left_keys = in_both(l, r, KEYS).select(*KEYS).distinct().collect()
    right_keys = in_both(r, l, KEYS).select(*KEYS).distinct().collect()
    assert left_keys == right_keys and len(left_keys) == 1


def test_columns_are_kept(spark):
    l, r = frames(spark, [("p", None, "1")], [("p", None, "1")])
    assert join_listed(l, r, KEYS).columns == l.columns
    assert only_in(l, r, KEYS).columns == l.columns
    assert reconcile(l, r, KEYS)[0].columns == [*l.columns, "status"]


def test_one_frame_on_both_sides(spark):
    l, _ = frames(spark, [("p", None, "1"), (None, None, None)], [])
    assert only_in(l, l, KEYS).count() == 0
    assert in_both(l, l, KEYS).count() == 2
    assert join_listed(l, l, KEYS).count() == 2


def test_listed_rows_multiply(spark):
    l, _ = frames(spark, [("p", None, "1"), ("q", None, "1"), ("r", None, "1")], [])
    listed = l.filter("a = 'p'").select(*KEYS)
    for _ in range(3):
        listed = listed.union(listed)
    listed = listed.union(l.filter("a = 'q'").select(*KEYS))
    rows = Counter(row.a for row in join_listed(l, listed, KEYS).collect())
    assert rows == {"p": 8, "q": 1}


def test_requested_only(spark):
    records = spark.createDataFrame([("p", 1), ("q", 2), (None, 3), ("p", 4)], "a string, n int")
    listed = spark.createDataFrame([("p",), ("p",), (None,)], "a string")
    assert ids(requested_only(records, listed, "a")) == [1, 4]


def test_discrepancy_and_empty_quadrant(spark):
    l, r = frames(spark, [("p", None, "1")], [("p", None, "1"), ("z", None, "1"), ("z", None, "1")])
    assert tuple(discrepancy(r, l, KEYS).first()) == (2, True)
    assert tuple(discrepancy(l, l, KEYS).first()) == (0, False)
    empty = no_keys(spark, l.select(*KEYS).schema)
    assert empty.count() == 0 and empty.columns == KEYS
    assert isinstance(empty.schema["d"].dataType, T.DateType)


def test_newest_and_order(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("d", None)], "p string, t int")
    assert tuple(newest(df, "t", "p").first()) == ("a", 2)
    assert newest(df.filter("t > 9"), "t", "p").count() == 0
    assert [row.t for row in in_order(df, ["t", "p"]).collect()] == [1, 2, 2, None]


def test_id_list(spark):
    ids = [f"UM{i * 7919 % 5000:08}" for i in range(5000)] * 2 + [None]
    df = spark.createDataFrame([(x,) for x in ids], "`p.id` string").repartition(7)
    (row,) = id_list(df, "p.id", sep=";").collect()
    expected = sorted(set(ids) - {None})
    assert (row.n_ids, row.id_list) == (5000, ";".join(expected))
    assert tuple(id_list(df.limit(0), "p.id").first()) == (0, "")


def test_key_batches(spark):
    rows = [("UM00000001",), ("UM00000003",), ("UM00000001",), ("UM00001001",), (None,)]
    out = key_batches(spark.createDataFrame(rows, "ptid string"), "ptid").collect()
    assert [tuple(row) for row in out] == [("0-0", 3, "UM00000001,UM00000003,UM00001001")]
    letters = ["x" * 9 + "".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(1500)]
    out = key_batches(spark.createDataFrame([(x,) for x in letters * 2], "`p.id` string"), "p.id", size=100).collect()
    assert all(row.n_ids == len(row.id_list.split(",")) <= 100 for row in out)
    assert sorted(x for row in out for x in row.id_list.split(",")) == sorted(letters)
    assert len({row.batch for row in out}) == len(out) < 40
    assert key_batches(spark.createDataFrame([], "ptid string"), "ptid").count() == 0


@pytest.fixture
def conf(spark):
    before = {}

    def change(**settings_):
        for name, value in settings_.items():
            name = "spark.sql." + name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


OPERATIONS = {
    "only_in": lambda l, r: only_in(l, r, KEYS),
    "in_both": lambda l, r: in_both(l, r, KEYS),
    "reconcile": lambda l, r: reconcile(l, r, KEYS)[0],
    "join_listed": lambda l, r: join_listed(l, r, KEYS),
    "requested_only": lambda l, r: requested_only(l, r, "a"),
}


@pytest.mark.parametrize("name", OPERATIONS)
def test_plan_stays_an_equi_join(spark, conf, name):
    text = F.col("id").cast("string")
    l = spark.range(9).select(text.alias("a"), F.current_date().alias("d"), text.alias("v"), "id")
    r = l.filter("id > 3")
    for threshold in ("-1", "10485760"):
        conf(autoBroadcastJoinThreshold=threshold)
        plan = OPERATIONS[name](l, r)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert ("SortMergeJoin" if threshold == "-1" else "BroadcastHashJoin") in plan


@pytest.mark.parametrize("name", OPERATIONS)
def test_hot_key_is_split(spark, conf, name):
    """A third of all rows under one key: adaptive execution cuts that partition in pieces."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="2KB",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="16",
    )
    hot = F.when(F.col("id") < 10000, F.lit("hot")).otherwise(F.col("id").cast("string"))
    rows = spark.range(0, 30000, 1, 8).select(
        hot.alias("a"),
        F.lit(None).cast("date").alias("d"),
        F.lit("001").alias("v"),
        F.concat(F.lit("payload "), F.sha2(F.col("id").cast("string"), 256)).alias("n"),
    )
    listed = rows.filter("a = 'hot'").limit(1).unionByName(rows.filter("a != 'hot'")).drop("n")
    if name == "only_in":
        listed = listed.filter("a != 'hot'")
    result = OPERATIONS[name](rows, listed)
    assert "skew=true" in final_plan(result)
    assert result.count() == (10000 if name == "only_in" else 30000)


def test_hot_listed_key_is_split(spark, conf):
    """The inner join also splits when it is the list that is hot (by its bytes after compression)."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="2KB",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="16",
    )
    hot = F.when(F.col("id") < 200000, F.lit("hot")).otherwise(F.col("id").cast("string"))
    listed = spark.range(0, 200320, 1, 32).select(
        hot.alias("a"), F.lit(None).cast("date").alias("d"), F.lit("001").alias("v")
    )
    result = join_listed(listed.distinct(), listed, KEYS)
    assert result.count() == 200320
    assert "skew=true" in final_plan(result)


def test_sorting_splits_equal_keys(spark, conf):
    conf(shuffle__partitions="8", adaptive__enabled="false")
    rows = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
    )
    ordered = in_order(rows, ["k"])
    assert ordered.columns == ["k"]
    sizes = ordered.groupBy(F.spark_partition_id()).count().collect()
    assert max(row["count"] for row in sizes) < 8000
    got = [row.k for row in ordered.collect()]
    assert got == sorted(got) and len(got) == 30000


def test_counts_need_one_shuffle_and_no_join(spark):
    l, r = frames(spark, [("p", None, "1")], [("p", None, "1")])
    plan = status_counts(l, r, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("hashpartitioning") == 1


def test_lookup_side_is_reduced_before_the_shuffle(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    l, r = frames(spark, [("p", None, "1")], [("p", None, "1")])
    plan = only_in(l, r, KEYS)._jdf.queryExecution().executedPlan().toString()
    lookup = plan[plan.rindex("Sort [") :]
    # reads upwards: a partial aggregate, then the shuffle, then the final one
    assert lookup.count("HashAggregate") == 2
    assert lookup.rindex("HashAggregate") > lookup.rindex("Exchange hashpartitioning")
    assert "n#" not in lookup.split("HashAggregate")[1]
