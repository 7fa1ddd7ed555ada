"""Row gates on status codes, with SQL's three-valued logic.

A missing status is neither verified nor unverified. "All verified" and "any unverified" are
therefore two tests, not each other's complement: a record with one missing status and all others
verified passes neither.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitrec.functions import column


def all_of(terms: Sequence[Column]) -> Column:
    return reduce(and_, terms)


def any_of(terms: Sequence[Column]) -> Column:
    return reduce(or_, terms)


def any_complete(df: DataFrame, columns: Sequence[str], code: int = 2) -> DataFrame:
    """Rows where at least one of the integer status columns has the code."""
    return df.filter(any_of([column(c) == F.lit(code) for c in columns]))
