"""Text cells to clean text and to integers. Bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitrec.functions.names import column


def blank_to_null(col: Column | str) -> Column:
    """Empty string becomes null; blanks inside or around text are kept."""
    return F.nullif(column(col), F.lit(""))


def clean_cell(col: Column | str) -> Column:
    """One CSV cell: trim spaces and tabs, then read an empty cell and ``NA`` as null."""
    trimmed = F.btrim(column(col), F.lit(" \t"))
    return F.when(~trimmed.isin("", "NA"), trimmed)


# A decimal number, as the cast understands it. Other text would cost an exception per row, and Java
# would also take a type suffix (``2d``) as part of the number.
_NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_integer(col: Column | str) -> Column:
    """Text to integer by truncation: ``2.7`` gives 2, anything that is no number gives null."""
    text = column(col).cast("string")
    # nearly all cells are plain integers; only the others pay for the long way
    return F.coalesce(
        F.when(text.rlike(r"^[0-9]{1,9}$"), text).try_cast("int"),
        F.when(text.rlike(_NUMBER), text).try_cast("double").try_cast("int"),
    )


def whole_number(col: Column | str) -> Column:
    """Text to integer for a column declared integer: ``2.7`` is a bad cell and gives null."""
    return column(col).try_cast("int")
