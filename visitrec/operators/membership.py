"""Which rows of one side exist on the other: semi, anti and tagged joins on null-safe keys.

A missing key part equals a missing key part, as in the source system. ``eqNullSafe`` on every key
keeps that an equi-join: Catalyst hashes ``coalesce(k, default), isnull(k)``.

Size and skew. For semi and anti joins the side that is only looked up is reduced to its distinct
keys; the partial aggregate does that before the shuffle, so a key that fills a third of that side
leaves each task as one row. The side that is kept is moved once, as a plain shuffle right under the
join. That is the shape in which adaptive execution splits a hot key's partition, on either side of
the inner join too (``spark.sql.adaptive.skewJoin``, on by default). It is kept on purpose: joining
on the plain keys would reuse the shuffle of ``distinct`` and lose the split. Nothing is broadcast by
hint: Spark does that only below ``spark.sql.autoBroadcastJoinThreshold``, by measured size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.functions import column

LEFT_ONLY = "left_only"
RIGHT_ONLY = "right_only"
BOTH = "both"


def only_in(side: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``side`` whose key is absent from ``other``; duplicates and columns are kept."""
    return _lookup(side, _distinct_keys(other, keys), keys, "left_anti")


def in_both(side: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``side`` whose key exists in ``other``; duplicates and columns are kept."""
    return _lookup(side, _distinct_keys(other, keys), keys, "left_semi")


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides in full, each row tagged ``status``: left_only, right_only or both.

    Two joins serve all four results of a reconciliation. When only one of them is wanted,
    ``only_in`` or ``in_both`` moves fewer rows; when only counts are, use ``status_counts``.
    """
    return (
        _tagged(left, right, keys, LEFT_ONLY),
        _tagged(right, left, keys, RIGHT_ONLY),
    )


def status_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts per side and status: always four rows ``(side, status, n_rows)``.

    No join: both sides are counted per key, with partial counts before the only shuffle.
    """
    per_key = (
        _count_side(left, keys, 1, 0)
        .unionByName(_count_side(right, keys, 0, 1))
        .groupBy(*keys)
        .agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
    )
    shared = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    totals = per_key.agg(
        F.sum(F.when(~shared, F.col("n_left"))).alias("left_alone"),
        F.sum(F.when(shared, F.col("n_left"))).alias("left_shared"),
        F.sum(F.when(~shared, F.col("n_right"))).alias("right_alone"),
        F.sum(F.when(shared, F.col("n_right"))).alias("right_shared"),
    )
    rows = [
        ("left", LEFT_ONLY, "left_alone"),
        ("left", BOTH, "left_shared"),
        ("right", RIGHT_ONLY, "right_alone"),
        ("right", BOTH, "right_shared"),
    ]
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(side).alias("side"),
                        F.lit(status).alias("status"),
                        F.coalesce(F.col(total), F.lit(0)).alias("n_rows"),
                    )
                    for side, status, total in rows
                ]
            )
        )
    )


def discrepancy(registry: DataFrame, local: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``(n_registry_only, must_resolve)``: does the registry hold unknown records?"""
    alone = status_counts(local, registry, keys).filter(F.col("status") == RIGHT_ONLY)
    return alone.select(
        F.col("n_rows").alias("n_registry_only"),
        (F.col("n_rows") > 0).alias("must_resolve"),
    )


def join_listed(
    records: DataFrame, listed: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Inner join that keeps the columns of ``records``: a record comes once per listed row."""
    return _lookup(records, listed.select(*map(column, keys)), keys, "inner")


def requested_only(records: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Records of the listed ids. The id list stays a DataFrame; it never visits the driver."""
    return in_both(records, listed.filter(column(key).isNotNull()), [key])


def no_keys(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The quadrant of records that exist on neither side: no rows, but the key columns."""
    return spark.createDataFrame([], schema)


def _lookup(
    side: DataFrame,
    found: DataFrame,
    keys: Sequence[str],
    how: str,
    extra: Sequence[str] = (),
) -> DataFrame:
    names = {key: f"_found_{key}" for key in keys}
    renamed = found.withColumnsRenamed(names)
    condition = reduce(
        and_, [column(key).eqNullSafe(column(names[key])) for key in keys]
    )
    joined = side.join(renamed, condition, how)
    return joined if how in ("left_anti", "left_semi") else joined.select(
        *map(column, side.columns), *extra
    )


def _tagged(
    side: DataFrame, other: DataFrame, keys: Sequence[str], alone: str
) -> DataFrame:
    found = _distinct_keys(other, keys).withColumn("_hit", F.lit(True))
    joined = _lookup(side, found, keys, "left", extra=["_hit"])
    status = F.when(F.col("_hit"), F.lit(BOTH)).otherwise(F.lit(alone))
    return joined.select(*map(column, side.columns), status.alias("status"))


def _distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*map(column, keys)).distinct()


def _count_side(
    df: DataFrame, keys: Sequence[str], left: int, right: int
) -> DataFrame:
    return df.select(
        *map(column, keys),
        F.lit(left).cast("long").alias("_l"),
        F.lit(right).cast("long").alias("_r"),
    )
