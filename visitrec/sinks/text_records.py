"""One line of text per record, by a layout the caller gives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitrec.functions import column
from visitrec.operators.columns import require_columns


def text_records(df: DataFrame, layout: Sequence[tuple[str, int, str]]) -> DataFrame:
    """One column ``value``: each ``(column, width, pad)`` of the layout, padded on the right.

    A value longer than its width, or one with a line break, stops the job: it would lose data or
    break the record.
    """
    require_columns(df, [name for name, _, _ in layout])
    return df.select(F.concat(*[_cell(*item) for item in layout]).alias("value"))


def write_text_records(
    df: DataFrame, layout: Sequence[tuple[str, int, str]], path: str
) -> str:
    text_records(df, layout).write.mode("overwrite").text(path)
    return path


def _cell(name: str, width: int, pad: str) -> Column:
    text = F.coalesce(column(name).cast("string"), F.lit(""))
    return F.when(
        F.length(text) > F.lit(width),
        F.raise_error(F.lit(f"value wider than {width} in column {name}")),
    ).when(
        text.rlike(r"[\r\n]"), F.raise_error(F.lit(f"line break in column {name}"))
    ).otherwise(F.rpad(text, width, pad))
