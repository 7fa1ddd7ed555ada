"""Flat JSON records, every value as text, ``""`` read as missing."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.functions import column as named
from visitrec.operators.columns import blanks_to_null
from visitrec.sources.split_text import JSON, SplitText
from visitrec.storage import Scratch

#: Records that are looked at before all of them are.
PROBED = 1000


def text_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


def read_records(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[str],
    one_array_per_file: bool = True,
    absent: str = "stop",
) -> DataFrame:
    """Records with the given fields, in the given order. Malformed JSON stops the job.

    So does a field that is in no record, as when it was renamed or an error message was landed instead of
    records; with ``absent="warn"`` it is reported and comes back as null. A field that is ``""`` everywhere is
    there; one that is null everywhere is not.

    An array is cut into its objects by many tasks (see ``split_text``); JSON lines
    (``one_array_per_file=False``) are read by Spark's own reader. Either way the files are read once: the records
    come back from the shared folder, and what fields they hold is counted while they are stored.
    """
    paths = path if isinstance(path, str) else list(path)
    if one_array_per_file:
        text = SplitText(spark, paths, JSON)
        _require_closed(text)
        parsed = F.from_json("record", text_schema(fields), {"mode": "FAILFAST"})
        raw = text.records().select(parsed.alias("row")).select("row.*")
        scratch = text.scratch
    else:
        raw = spark.read.schema(text_schema(fields)).option("mode", "FAILFAST").json(paths)
        scratch = Scratch(spark, "records")
    held = Observation("held")
    counts = [F.count(named(name)).alias(f"f{i}") for i, name in enumerate(fields)]
    stored = scratch.keep(raw.observe(held, F.count(F.lit(1)).alias("records"), *counts), "records")
    if one_array_per_file:
        scratch.drop("chunks")
        scratch.drop("crossing")
    found = held.get
    lacking = [name for i, name in enumerate(fields) if not found[f"f{i}"]] if found["records"] else []
    if lacking:
        message = f"fields that no record holds: {', '.join(lacking)}"
        if absent != "warn":
            raise ValueError(message)
        warnings.warn(message, stacklevel=2)
    return blanks_to_null(stored)


def _require_closed(text: SplitText) -> None:
    """Stop where a file begins as an array and doesn't end as one."""
    ends = (
        text.stored.filter("first IS NOT NULL")
        .groupBy("file")
        .agg(
            F.min_by("first", F.struct("start", "chunk")).alias("first"),
            F.max_by("last", F.struct("start", "chunk")).alias("last"),
        )
        .filter("first = X'5B' AND last <> X'5D'")
    )
    broken = ends.first()
    if broken is not None:
        raise PySparkValueError(f"malformed JSON: the array in {broken['file']} has no end")


def records_from_text(
    df: DataFrame, column: Column | str, fields: Sequence[str]
) -> DataFrame:
    """One row per object of the JSON arrays held in a text column. A field in no object stops the job."""
    parsed = F.from_json(named(column), T.ArrayType(text_schema(fields)), {"mode": "FAILFAST"})
    return blanks_to_null(require_held(df.select(F.inline(parsed))))


def require_held(records: DataFrame) -> DataFrame:
    """The records, if each of their columns has a value in some record, or there are no records.

    The first records nearly always hold all fields; only fields that they lack are looked for in all records.
    """
    few = records.limit(PROBED).agg(
        F.count(F.lit(1)).alias("records"), *[F.count(named(name)) > 0 for name in records.columns]
    )
    count, *held = few.first()
    lacking = [name for name, found in zip(records.columns, held) if not found]
    if count and lacking:
        held = records.agg(*[F.count(named(name)) > 0 for name in lacking]).first()
        absent = [name for name, found in zip(lacking, held) if not found]
        if absent:
            raise ValueError(f"fields that no record holds: {', '.join(absent)}")
    return records
