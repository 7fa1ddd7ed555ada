"""Suffix arrays by induced sorting, and permuted common prefixes, as numpy steps over whole buckets."""

from __future__ import annotations

import numpy as np

from visitrec.llm import arrays as A

#: With more symbols than this, buckets are so small that suffixes are placed one by one.
MOST_SYMBOLS = 512
#: So many suffixes or fewer are placed one by one in any bucket.
FEW = 12


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the suffix after them; the last symbol is the least and counts as such."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    rises = np.append(text[:-1] < text[1:], True)
    decides = np.where(differs, np.arange(n), n)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    return rises[decides]


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """Sort all suffixes, given the leftmost smaller ones in order (or in any order, to sort their substrings).

    Bucket by bucket: every sorted suffix puts the one that starts a symbol earlier into that one's bucket,
    larger ones from the front in a rising pass, smaller ones from the back in a falling pass.
    """
    if symbols > MOST_SYMBOLS:
        return _induce_singly(text, small, seeds, symbols)
    n = len(text)
    counts = np.bincount(text, minlength=symbols)
    heads = np.concatenate([[0], np.cumsum(counts)])
    order, larger = np.full(n, -1, dtype=np.int64), ~small

    seed_symbols = text[seeds]
    seed_at = np.searchsorted(seed_symbols, np.arange(symbols + 1))  # seeds come sorted by first symbol
    front = heads[:-1].copy()
    for c in range(symbols):
        done = heads[c]
        while True:
            fresh = order[done : front[c]]
            done = front[c]
            if len(fresh):
                _put(fresh, text, larger, order, front, symbols, 1)
            elif done == front[c]:
                break
        _put(seeds[seed_at[c] : seed_at[c + 1]], text, larger, order, front, symbols, 1)

    back = heads[1:].copy()
    for c in range(symbols - 1, -1, -1):
        done = heads[c + 1]
        while True:
            fresh = order[back[c] : done][::-1]
            done = back[c]
            if len(fresh):
                _put(fresh, text, small, order, back, symbols, -1)
            elif done == back[c]:
                break
        _put(order[heads[c] : front[c]][::-1], text, small, order, back, symbols, -1)
    order[0] = n - 1  # the last symbol alone: the least suffix, before which nothing smaller was induced
    return order


def _put(suffixes, text, wanted, order, ends, symbols, way) -> None:
    """Place what starts a symbol before each suffix, in that order, at the open end of its bucket."""
    if len(suffixes) <= FEW:
        for s in suffixes.tolist():
            if s and wanted[s - 1]:
                c = text[s - 1]
                order[ends[c] if way > 0 else ends[c] - 1] = s - 1
                ends[c] += way
        return
    before = suffixes[suffixes > 0] - 1
    before = before[wanted[before]]
    if not len(before):
        return
    keys = text[before]
    by = np.argsort(keys, kind="stable")
    keys, before = keys[by], before[by]
    counts = np.bincount(keys, minlength=symbols)
    within = np.arange(len(keys)) - (np.cumsum(counts) - counts)[keys]
    if way > 0:
        order[ends[keys] + within] = before
        ends += counts
    else:
        order[ends[keys] - 1 - within] = before
        ends -= counts


def _induce_singly(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """The same order, in time that doesn't depend on the number of symbols: a step for each suffix."""
    n = len(text)
    heads = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))]).astype(np.int64)
    order = np.full(n, -1, dtype=np.int64)
    # seeds stand at the back of their buckets until the rising pass has used them
    seed_symbols = text[seeds]
    from_back = np.searchsorted(seed_symbols, seed_symbols, side="right") - np.arange(len(seeds))
    order[heads[1:][seed_symbols] - from_back] = seeds
    symbol, smaller, place = memoryview(text), memoryview(small.view(np.uint8)), memoryview(order)

    front = memoryview(heads[:-1].copy())
    for i in range(n):
        s = place[i] - 1
        if s >= 0 and not smaller[s]:
            c = symbol[s]
            place[front[c]] = s
            front[c] += 1
    # the falling pass writes all smaller suffixes anew, from the back, seeds among them
    back = memoryview(heads[1:].copy())
    for i in range(n - 1, -1, -1):
        s = place[i] - 1
        if s >= 0 and smaller[s]:
            c = symbol[s]
            back[c] -= 1
            place[back[c]] = s
    order[0] = n - 1
    return order


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of the sorted suffixes of a text of whole numbers that ends with its only 0."""
    n = len(text)
    if n < 3:
        return np.argsort(text, kind="stable")[::1] if n < 2 else np.array([1, 0])
    small = smaller_than_next(text)
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    by_symbol = left[np.argsort(text[left], kind="stable")]
    order = _induce(text, small, by_symbol, symbols)

    is_left = np.zeros(n, dtype=bool)
    is_left[left] = True
    order = order[is_left[order]]
    ends = np.append(left[1:] + 1, n)  # each substring runs up to the next one's first symbol
    place = np.empty(n, dtype=np.int64)
    place[left] = np.arange(len(left))
    codes = A.mix(np.arange(1, symbols + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    hashes = A.Rolling(text, codes).of(left, ends)[place[order]]
    ranks = np.concatenate([[0], np.cumsum(hashes[1:] != hashes[:-1])])
    names = np.empty(len(left), dtype=np.int64)
    names[place[order]] = ranks
    if ranks[-1] == len(left) - 1:
        sorted_left = order
    else:
        sorted_left = left[suffix_array(names, int(ranks[-1]) + 1)]
    return _induce(text, small, sorted_left, symbols)


def permuted_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start: the start sorted before it (-1 for none), and how long a prefix the two share.

    A value is only found by comparing where the symbols before both differ; elsewhere it is one less than that
    of the start before.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    starts = np.arange(n)
    compare = (starts == 0) | (before <= 0)
    rest = np.flatnonzero(~compare)
    compare[rest] = text[rest - 1] != text[before[rest] - 1]
    shared = np.zeros(n, dtype=np.int64)
    live = np.flatnonzero(compare & (before >= 0))
    padded = np.concatenate([text, np.zeros(32, dtype=text.dtype)])
    steps = np.arange(32)
    while len(live):
        a, b = live + shared[live], before[live] + shared[live]
        differ = padded[a[:, None] + steps] != padded[b[:, None] + steps]
        found = differ.any(axis=1)
        shared[live] += np.where(found, differ.argmax(axis=1), 32)
        live = live[~found]
    last = np.maximum.accumulate(np.where(compare, starts, 0))
    return before, np.maximum(shared[last] - (starts - last), 0)


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string: the starts of ``length`` bytes that also start anywhere else in the strings."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    data = np.frombuffer(b"".join(strings), np.uint8)
    text = np.empty(len(data) + len(strings) + 1, dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    inside = np.ones(len(text), dtype=bool)
    inside[begins + sizes] = False
    inside[-1] = False
    text[inside] = data.astype(np.int64) + 2
    text[begins + sizes] = 1
    text[-1] = 0
    order = suffix_array(text, 258)
    before, shared = permuted_prefixes(text, order)
    twice = np.flatnonzero(shared >= length)
    marked = np.zeros(len(text), dtype=bool)
    marked[twice] = True
    marked[before[twice]] = True
    return [
        np.flatnonzero(marked[b : b + max(0, s - length + 1)]) for b, s in zip(begins.tolist(), sizes.tolist())
    ]
