"""A Bloom filter of listed ids, tested before wide records are shuffled.

The filter is a set of blocks of ``BLOCK_BITS`` bits, one row each: an id's hash names its block and ``PROBES``
bits in it. The blocks are built by partial aggregation and are at most ``MOST_BLOCKS``, 8 MB in all, whatever the
number of ids; that bound is why they may be broadcast. Records that fail the test have no listed id; a few that pass
have none either, so the exact join follows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.functions import column

#: Fixed value: the bits of one bitmap of ``bitmap_construct_agg``.
BLOCK_BITS = 32768
MOST_BLOCKS = 2048
PROBES = 4
#: Bits for each id: with 16, one record in 400 passes for nothing; with fewer than ``LEAST_BITS`` it does not pay.
ID_BITS, LEAST_BITS = 16, 4

_EXACT = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def sieve_blocks(n_ids: int) -> int:
    """How many blocks for so many ids, a power of two; 0 if a filter of bounded size would let too much pass."""
    wanted = max(1, -(-n_ids * ID_BITS // BLOCK_BITS))
    blocks = min(1 << (wanted - 1).bit_length(), MOST_BLOCKS)
    return blocks if blocks * BLOCK_BITS >= n_ids * LEAST_BITS else 0


def sieve(records: DataFrame, listed: DataFrame, key: str, n_ids: int) -> DataFrame:
    """The records whose ``key`` is in ``listed``, and few others; columns and repeated records are kept.

    ``n_ids`` is the number of listed ids, at least about: it sizes the filter and never changes which listed
    records come through. A null is an id like any other. Beyond some 16 million ids, and for keys
    whose equal values may differ in type or form, all records come through.
    """
    own, other = records.schema[key].dataType, listed.schema[key].dataType
    blocks = sieve_blocks(n_ids)
    if not blocks or own != other or not isinstance(own, _EXACT):
        return records
    bits = F.array(*_places(column(key)))
    filled = (
        listed.select(_block(column(key), blocks).alias("_sieve_block"), F.explode(bits).alias("_place"))
        .groupBy("_sieve_block")
        .agg(F.bitmap_construct_agg("_place").alias("_sieve_bits"))
    )
    hit = reduce(and_, (_is_set(place) for place in _places(column(key))))
    met = records.join(F.broadcast(filled), _block(column(key), blocks) == F.col("_sieve_block"))
    return met.filter(hit).select(*map(column, records.columns))


def _block(key: Column, blocks: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(blocks - 1).cast("long"))


def _places(key: Column) -> list[Column]:
    """Bits of the block: 15 bits each of a second hash."""
    second = F.xxhash64(key, F.lit("place"))
    return [
        F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1).cast("long")) for i in range(PROBES)
    ]


def _is_set(place: Column) -> Column:
    one = F.substring(F.col("_sieve_bits"), F.shiftright(place, 3).cast("int") + 1, F.lit(1))
    byte = F.conv(F.hex(one), 16, 10).cast("int")
    bit = place.bitwiseAND(F.lit(7).cast("long")).cast("int")
    return F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1
