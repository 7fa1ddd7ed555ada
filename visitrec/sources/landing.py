"""The landing folder: which files are there, which is newest, and is it from today."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitrec.functions import date_in_zone, run_date_text
from visitrec.functions.dates import RUN_ZONE
from visitrec.operators.ranking import newest


def landing_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, modified)`` of the files directly in the folder. File contents are not read.

    The lookup is recursive because it else takes a subfolder ``name=value`` for a partition and leaves
    out the files beside it; what lies deeper is dropped.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    parent = F.regexp_replace("path", "/[^/]*$", "")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(literal_path(folder))
        .filter(parent == system.makeQualified(path).toString())
        .select("path", F.col("modificationTime").alias("modified"))
    )


def literal_path(path: str) -> str:
    """The path with marks of patterns escaped: readers take it as it is."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def newest_file(files: DataFrame) -> DataFrame:
    """The newest file; the first path wins a draw."""
    return newest(files, by="modified", tie="path")


def freshness(
    latest: DataFrame,
    run_date: dt.date | str,
    path: str = "path",
    modified: str = "modified",
    zone: str = RUN_ZONE,
) -> DataFrame:
    """``(path, file_date, run_date, is_stale)`` of the newest input; the caller decides to warn.

    One projection: over a second one Spark would no longer plan ``newest`` as a top-1.
    """
    day = F.lit(run_date_text(run_date)).cast("date")
    file_date = date_in_zone(modified, zone)
    return latest.select(
        F.col(path).alias("path"),
        file_date.alias("file_date"),
        day.alias("run_date"),
        (file_date != day).alias("is_stale"),
    )
