"""Texts as numpy arrays: words, their hashes and the hashes of word runs, a block of texts at a time.

A block holds the bytes of some rows, each followed by one space, so a task's memory is bounded by
``BLOCK_BYTES`` or by its longest text, whatever the size of its partition.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, and 5 modulo 8: its powers modulo 2**64 repeat as late as can be
_INVERSE = pow(_BASE, -1, 1 << 64)


def give_back() -> None:
    """Return freed memory to the machine: Spark's Python workers live on from stage to stage, and so would it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # of the GNU C library alone
        ctypes.CDLL(None).malloc_trim(0)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits; one to one."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


#: A random number for each byte; the second table gives A-Z those of a-z.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
FOLDED_CODES = BYTE_CODES.copy()
FOLDED_CODES[ord("A") : ord("Z") + 1] = BYTE_CODES[ord("a") : ord("z") + 1]


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Bytes of words: anything but ASCII white space; digits, letters and all beyond ASCII.
WORD_BYTES = ~byte_table(b" \t\n\x0b\x0c\r")
ALNUM_BYTES = byte_table(bytes(b for b in range(256) if b >= 0x80 or chr(b).isalnum()))

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grown(have: np.ndarray, n: int, factor: int) -> np.ndarray:
    while len(have) < n:
        step = np.uint64(pow(factor, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    return have


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the hash base and of its inverse."""
    global _powers, _inverses
    if len(_powers) < n:
        _powers, _inverses = _grown(_powers, n, _BASE), _grown(_inverses, n, _INVERSE)
    return _powers[:n], _inverses[:n]


class Rolling:
    """Hashes of any stretch of a byte array in constant time."""

    def __init__(self, data: np.ndarray, codes: np.ndarray) -> None:
        up, self.down = powers(len(data) + 1)
        self.sums = np.empty(len(data) + 1, dtype=np.uint64)
        self.sums[0] = 0
        np.cumsum(codes[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + lengths)


#: Longer stretches are hashed one by one.
LONG_BYTES = 512

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += ord("a") - ord("A")
_TAIL_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [_MASK], dtype=np.uint64)


def folded(data: np.ndarray) -> np.ndarray:
    """The bytes with a-z for A-Z."""
    return _LOWER[data]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of each stretch ``data[start:end]``, eight bytes at a step, each step mixed into the last.

    Nothing in it is linear in the bytes, so regular texts collide no more often than others. It serves where
    equality is taken from the hash; ``Rolling`` is for windows of which neighbours share most bytes.
    """
    starts, lengths = np.asarray(starts, dtype=np.int64), np.asarray(ends - starts, dtype=np.int64)
    out = mix(lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed + 1))
    long = np.flatnonzero(lengths > LONG_BYTES)
    for i in long.tolist():
        key = seed.to_bytes(8, "little")
        stretch = data[starts[i] : starts[i] + lengths[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(stretch, digest_size=8, key=key).digest(), "little")
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    live = np.flatnonzero((lengths > 0) & (lengths <= LONG_BYTES))
    at = 0
    while len(live):
        left = lengths[live] - at
        lane = eights[starts[live] + at] & _TAIL_MASKS[np.minimum(left, 8)]
        out[live] = mix(out[live] ^ mix(lane + np.uint64(0xA0761D6478BD642F)))
        at += 8
        live = live[left > 8]
    return out


@dataclass
class Block:
    """Rows ``first`` to ``last`` of a batch. Text i is ``data[starts[i]:ends[i]]``."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return self.last - self.first


def text_bytes(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of all texts and their offsets; a null counts as an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return memoryview(data if data is not None else b""), bounds


def _cuts(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    first, count = 0, len(bounds) - 1
    while first < count:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def parts(batch: pa.RecordBatch, column: str | int = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into rows whose texts have about ``limit`` bytes; nothing is copied."""
    if len(batch):
        for first, last in _cuts(text_bytes(batch.column(column))[1], limit):
            yield batch.slice(first, last - first)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a column of texts into blocks of about ``limit`` bytes."""
    if not len(texts):
        return
    data, bounds = text_bytes(texts)
    for first, last in _cuts(bounds, limit):
        cuts = bounds[first : last + 1].tolist()
        joined = b" ".join([data[a:b] for a, b in zip(cuts, cuts[1:])]) + b" "
        shifted = bounds[first : last + 1] - bounds[first] + np.arange(last - first + 1)
        yield Block(first, last, np.frombuffer(joined, np.uint8), shifted[:-1], shifted[1:] - 1)


@dataclass
class Words:
    """Words of a block: byte bounds, and the first word of each text (one more for the end)."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(block: Block, members: np.ndarray = WORD_BYTES) -> Words:
    """The maximal runs of member bytes; none crosses from one text into the next."""
    inside = members[block.data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        change = np.concatenate([[0], change])
    starts, ends = change[::2], change[1::2]  # every text is followed by a space
    return Words(starts, ends, np.append(np.searchsorted(starts, block.starts), len(starts)))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of words i to i + n - 1, for every i that has n words from there on."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(count, n, dtype=np.uint64)
    for j in range(n):
        out += words[j : j + count]
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return mix(out)


def runs_inside(words: Words, n: int) -> np.ndarray:
    """Whether the run of n words from word i stays in one text, for every i of ``run_hashes``."""
    count = int(words.first[-1]) - n + 1
    if count <= 0:
        return np.empty(0, dtype=bool)
    inside = np.ones(count, dtype=bool)
    for j in range(1, n):
        crossing = words.first[1:-1] - j
        inside[crossing[(crossing >= 0) & (crossing < count)]] = False
    # a text shorter than n words has runs that start before its first word and end after its last
    return inside


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours; one value for every full window."""
    return _sliding(values, width, np.minimum)


def sliding_max(values: np.ndarray, width: int) -> np.ndarray:
    return _sliding(values, width, np.maximum)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values under the long type that Spark has."""
    return pa.array(values.view(np.int64))
