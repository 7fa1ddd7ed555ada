"""Tests on coded text. Codes are compared as text, so ``02`` is not ``2`` and ``x`` is no error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitrec.functions.names import column

# The answer codes of a type checkbox group, in order of precedence.
TYPE_CODES = (1, 2, 3, 9)


def is_code(col: Column | str, code: str | int) -> Column:
    """Null in, null out, like any SQL comparison."""
    return _text(col) == F.lit(str(code))


def is_not_code(col: Column | str, code: str | int) -> Column:
    return _text(col) != F.lit(str(code))


def matches(col: Column | str, pattern: str) -> Column:
    """Regex search; it matches a part of the text unless the pattern is anchored."""
    return _text(col).rlike(pattern)


def first_ticked(prefix: str, codes: Sequence[int] = TYPE_CODES) -> Column:
    """The first code whose box ``<prefix>___<code>`` is ticked, as an integer, else null."""
    return F.coalesce(
        *[F.when(is_code(f"{prefix}___{code}", 1), F.lit(code)) for code in codes]
    ).cast("int")


def _text(col: Column | str) -> Column:
    return column(col).cast("string")
