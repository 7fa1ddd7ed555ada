"""A set of hashes as a bitmap of fixed size, for leaving out rows before a shuffle.

Its size is a parameter and doesn't grow with the set. It may say yes for a hash outside the set, more
often the more hashes there are; it never says no for one inside. An exact join follows every use.
"""

from __future__ import annotations

import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24


def bitmap_of(df: DataFrame, hashes: Column, bits: int = BITS) -> Broadcast:
    """Broadcast the set; at most ``2 ** bits / 64`` longs reach the driver."""
    slot = F.shiftrightunsigned(hashes, 64 - bits)
    word = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    rows = (
        df.select(slot.alias("slot"))
        .select(F.shiftright("slot", 6).alias("at"), word.alias("word"))
        .groupBy("at")
        .agg(F.bit_or("word").alias("word"))
        .toPandas()
    )
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[rows["at"].to_numpy(dtype=np.int64)] = rows["word"].to_numpy(dtype=np.int64).view(np.uint64)
    return df.sparkSession.sparkContext.broadcast(table)


def may_be_in(found: Broadcast, hashes: Column) -> Column:
    """The same test for a column of hashes."""

    @F.pandas_udf("boolean")
    def test(values):
        return type(values)(may_hold(found.value, values.to_numpy().view(np.uint64)))

    return test(hashes)


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For unsigned hashes: False only if a hash isn't in the set."""
    bits = int(len(table)).bit_length() - 1 + 6
    slot = hashes >> np.uint64(64 - bits)
    return (table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
