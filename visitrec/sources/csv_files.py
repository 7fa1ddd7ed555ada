"""CSV with a header: cells trimmed, empty cells and ``NA`` read as null, doubled quotes."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkValueError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.functions import clean_cell, column, whole_number
from visitrec.operators.columns import require_columns
from visitrec.sources.split_text import CSV, SplitText

# Registry columns declared integer; all others stay text.
REGISTRY_INTEGERS = ("VISITMO", "VISITDAY", "VISITYR")


_DIALECT = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    multi_line: bool | None = None,
    by_name: bool = False,
) -> DataFrame:
    """All columns as text, under the names in the header.

    Files are read by many tasks, also where cells hold line breaks (see ``split_text``), and read once: what
    comes back stands in the shared folder. A caller who knows that no cell holds a line break may say so
    (``multi_line=False``); then Spark's own reader takes lines for records and nothing is stored.

    Each file has a header. A file whose header differs from the others' stops the job, unless ``by_name`` is
    set: then columns go by their names in each file, whatever their order, and those that a file lacks are null.
    Lines end in a line feed, with or without a carriage return; blank lines are left out.
    """
    paths = path if isinstance(path, str) else list(path)
    if multi_line is False and not by_name:
        # no schema is given, because Spark would apply it by position and not by name
        raw = (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .option("inferSchema", False)
            .options(**_DIALECT)
            .csv(paths)
        )
        return raw.select(*[clean_cell(c).alias(c) for c in raw.columns])
    text = SplitText(spark, paths, CSV)
    # a row for each different header
    headers = [
        (bytes(row["record"]).decode(errors="replace"), row["files"])
        for row in text.first_records().groupBy("record").agg(F.collect_list("file").alias("files")).collect()
    ]
    names = [_header_names(header) for header, _ in headers]
    if not headers:
        return spark.createDataFrame([], T.StructType([]))
    if not by_name and len({tuple(n) for n in names}) > 1:
        raise PySparkValueError(f"files have different headers: {sorted(names)[:2]}")
    records = text.records(skip_first=True).withColumn("record", F.rtrim("record", F.lit("\r")))
    if len({tuple(n) for n in names}) == 1:
        return _cells(records, names[0])
    parts = [
        _cells(records.filter(F.col("file").isin(files)), own) for (_, files), own in zip(headers, names)
    ]
    return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), parts)


def _header_names(header: str) -> list[str]:
    """Names in a header; a name that occurs twice gets its place, one that is empty is ``_c`` and its place."""
    cells = [cell.strip(" \t\r\n") for cell in next(csv.reader([header], skipinitialspace=True, strict=False))]
    times = Counter(cell.lower() for cell in cells)
    return [
        f"_c{i}" if not cell else f"{cell}{i}" if times[cell.lower()] > 1 else cell for i, cell in enumerate(cells)
    ]


def _cells(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """Records cut into cells, by place."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    row = F.from_csv("record", schema.simpleString()[len("struct<") : -1].replace(":", " "), _DIALECT)
    cut = records.select(row.alias("row")).select("row.*")
    return cut.select(*[clean_cell(f"c{i}").alias(name) for i, name in enumerate(names)])


def breaks_in_quotes(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """True if some line has an odd number of quotes, as the start of a broken cell must have."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def read_registry(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool | None = None
) -> DataFrame:
    """Registry visits: text by default, the three date parts as integers. Columns go by name in each file."""
    return declare_integers(read_csv(spark, path, multi_line, by_name=multi_line is not False))


def declare_integers(
    df: DataFrame, columns: Sequence[str] = REGISTRY_INTEGERS
) -> DataFrame:
    """Named columns as integers; a bad cell becomes null."""
    require_columns(df, columns)
    return df.select(
        *[whole_number(c).alias(c) if c in columns else column(c) for c in df.columns]
    )


def read_push_list(
    spark: SparkSession, path: str, multi_line: bool | None = None
) -> DataFrame:
    """The push list of a run. ``visitnum`` keeps its leading zeros because nothing is guessed."""
    return read_csv(spark, path, multi_line)
