"""Columns by name, also names with dots or spaces in them, as file headers may have."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: Column | str) -> Column:
    """The column of that exact name; a column is passed through."""
    if isinstance(name, Column):
        return name
    return F.col("`" + name.replace("`", "``") + "`")
