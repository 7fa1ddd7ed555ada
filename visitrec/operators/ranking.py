"""Newest row, ordered output, and id lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitrec.functions import column


def newest(df: DataFrame, by: str, tie: str) -> DataFrame:
    """The row with the largest ``by``; the smallest ``tie`` wins a draw. Planned as a top-1."""
    return df.orderBy(F.desc_nulls_last(by), F.asc_nulls_last(tie)).limit(1)


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ascending by every column, missing values last.

    The last sort term lets the range partitioner cut a run of equal keys, which would otherwise be
    one task. It names the input partition and not the row, so a repeated task sorts alike.
    """
    return df.orderBy(
        *[F.asc_nulls_last(c) for c in columns], F.spark_partition_id().asc()
    )


def id_list(df: DataFrame, key: str, sep: str = ",") -> DataFrame:
    """All different ids in one text, ascending: one row ``(n_ids, id_list)``.

    Ids are dealt by ranges, each range is sorted and joined by its own task, and the ranges' texts are joined by the
    number of their range. So no buffer holds single ids of more than one range; the text itself is one value and
    must fit into one (2 GB). Where it may not, use ``key_batches``. Without ids the text is empty.
    """
    ids = df.select(column(key).cast("string").alias("id")).filter("id IS NOT NULL").distinct()
    ranges = ids.repartitionByRange("id").select("id", F.spark_partition_id().alias("range"))
    joined = ranges.groupBy("range").agg(
        F.array_join(F.sort_array(F.collect_list("id")), sep).alias("ids"), F.count(F.lit(1)).alias("n_ids")
    )
    parts = F.array_sort(F.collect_list(F.struct("range", "ids")))
    return joined.agg(
        F.coalesce(F.sum("n_ids"), F.lit(0)).alias("n_ids"),
        F.array_join(F.transform(parts, lambda part: part["ids"]), sep).alias("id_list"),
    )


def key_batches(df: DataFrame, key: str, sep: str = ",", size: int = 1000) -> DataFrame:
    """The ids as ready-made request lists of ``size`` ids at most: rows ``(batch, n_ids, id_list)``.

    One list of all ids would be a single value that grows with the data. The ids are counted once, and a
    digest of each deals them into so many buckets that one holds ``size`` on average, whatever the ids
    look like; a fuller bucket is cut. An id asked for twice is sent once; the set is built before the
    shuffle, so repeats cost nothing.
    """
    ids = df.select(column(key).alias("id")).filter("id IS NOT NULL")
    buckets = max(1, -(-ids.agg(F.count_distinct("id")).first()[0] // size))
    digest = F.conv(F.left(F.md5("id"), F.lit(8)), 16, 10).cast("long")
    starts = F.sequence(F.lit(1), F.size("ids"), F.lit(size))
    parts = F.transform(starts, lambda start: F.slice("ids", start, F.lit(size)))
    return (
        ids.groupBy((digest % buckets).alias("bucket"))
        .agg(F.sort_array(F.collect_set("id")).alias("ids"))
        .select("bucket", F.posexplode(parts).alias("part", "ids"))
        .select(
            F.concat_ws("-", "bucket", "part").alias("batch"),
            F.size("ids").alias("n_ids"),
            F.array_join("ids", sep).alias("id_list"),
        )
    )
