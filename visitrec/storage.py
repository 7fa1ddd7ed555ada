"""Where a job keeps tables between its steps: the folder that all machines of the cluster share."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Only a session whose driver runs every task may go without one; it gets a temporary folder. On a
    cluster an unset folder stops the job, for executors could not read each other's local disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="visitrec-")


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system that holds the path, and what makes a path of it."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file of the driver's."""
    system, at = file_system(spark, path)
    stream = system.create(at(path), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small file of the driver's."""
    system, at = file_system(spark, path)
    stream = system.open(at(path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class Scratch:
    """Tables of one run, in a folder of their own below the shared one."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/visitrec/{name}-{uuid.uuid4().hex}"

    def path(self, label: str) -> str:
        return f"{self.root}/{label}"

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write the rows once and read them from there: later steps start from these files."""
        df.write.parquet(self.path(label))
        return self.spark.read.schema(df.schema).parquet(self.path(label))

    def keep_parted(self, df: DataFrame, label: str, by: list[str]) -> DataFrame:
        """The same, a folder for each value of the columns ``by``: who filters on them reads those alone."""
        df.write.partitionBy(*by).parquet(self.path(label))
        kept = [field for field in df.schema.fields if field.name not in by]
        schema = T.StructType([*kept, *(df.schema[name] for name in by)])
        return self.spark.read.schema(schema).parquet(self.path(label))

    def drop(self, label: str = "") -> None:
        """Remove a table that no later step reads, or the whole folder.

        Spark keeps the shuffle files of finished steps until its driver collects their owners, so it is asked
        to do that now.
        """
        system, at = file_system(self.spark, self.root)
        system.delete(at(self.path(label) if label else self.root), True)
        self.spark._jvm.System.gc()
