"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces and their log scores come from a model file; a file of merges has ranks, from which Zipf's law makes
log scores. Spaces become whitespace markers; one stands before a
text. Of all ways to cut a text into pieces the one with the highest sum of scores is taken; a character that
no piece spells is written as its bytes.

No piece has a marker after another character, so the best cut of a text is the best cuts of its words side
by side. Each different word of a block is cut once, all words of like length together, step by step.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.llm import arrays as A

MARKER = "▁"
#: Below the least score of a piece: an unknown character.
UNKNOWN_PENALTY = 10.0
BLOCK_BYTES = 1 << 20
#: Bytes of words that are cut together.
TOGETHER = 1 << 18
#: Longer words are cut one by one.
LONG_WORD = 256

# Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Numbers and values of a protocol buffer's fields."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class Pieces:
    """Pieces of a model file by id, their log scores and kinds."""

    texts: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    ranked: bool = False  # scores are minus the rank of a merge, not logarithms


def read_pieces(model: bytes) -> Pieces:
    """Parse a model file. Only files that leave the text as it is but for spaces can be read."""
    pieces = Pieces()
    for number, value in _fields(model):
        if number == 1:
            own = dict(_fields(value))
            pieces.texts.append(own[1].decode())
            pieces.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            pieces.kinds.append(own.get(3, _NORMAL))
        elif number == 2:
            pieces.ranked = dict(_fields(value)).get(3, 1) == 2
        elif number == 3:
            own = dict(_fields(value))
            if own.get(2, b"") or not own.get(3, 1) or own.get(4, 1) or not own.get(5, 1):
                raise ValueError("the model's text normalization isn't supported")
    return pieces


class Trie:
    """A double array over the pieces' bytes, a marker being the byte of a space.

    The child of state s by byte c is ``base[s] + c`` if ``check`` of that is s. ``piece`` is the id of the
    piece that ends at a state, or -1.
    """

    def __init__(self, words: dict[bytes, int]) -> None:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for word, number in words.items():
            node = 0
            for byte in word:
                node = children[node].setdefault(byte, len(children))
                if node == len(children):
                    children.append({})
                    ends.append(-1)
            ends[node] = number
        size = len(children) * 4 + 4096
        self.base = np.zeros(size, dtype=np.int32)
        self.check = np.full(size, -1, dtype=np.int32)
        self.piece = np.full(size, -1, dtype=np.int32)
        self.check[0] = 0
        used = bytearray(size)
        used[0] = 1
        free, wide, place = 257, 257, {0: 0}
        order = [0]
        for node in order:
            state, labels = place[node], sorted(children[node])
            self.piece[state] = ends[node]
            if not labels:
                continue
            while used[free]:
                free += 1
            wide = max(wide, free)
            # an only child goes into the first gap; others are sought beyond what has become dense
            at, tries = (free if len(labels) == 1 else wide), 0
            while at <= labels[0] or any(used[at - labels[0] + c] for c in labels):
                at, tries = at + 1, tries + 1
            if len(labels) > 1 and tries > 64:
                wide = at - 32
            base = at - labels[0]
            self.base[state] = base
            for c in labels:
                used[base + c] = 1
                self.check[base + c] = state
                place[children[node][c]] = base + c
                order.append(children[node][c])
        top = int(np.flatnonzero(self.check >= 0).max()) + 257
        self.base, self.check, self.piece = (
            np.concatenate([a[:top], np.full(max(0, top - len(a)), fill, dtype=np.int32)])
            for a, fill in ((self.base, 0), (self.check, -1), (self.piece, -1))
        )


@dataclass
class UnigramModel:
    trie: Trie
    scores: np.ndarray
    unknown: float
    byte_ids: np.ndarray
    spelled: list[bytes]
    by_word: bool
    apart: np.ndarray  # bytes that no longer piece holds: always cut off


def load_model(data: bytes) -> UnigramModel:
    pieces = read_pieces(data)
    words, byte_ids, spelled = {}, np.full(256, -1, dtype=np.int64), []
    scores = np.array(pieces.scores, dtype=np.float64)
    if pieces.ranked:  # the share that Zipf's law gives a piece of that rank
        scores = -np.log(2 + np.minimum(-scores, len(scores)))
    normal = [s for s, k in zip(scores.tolist(), pieces.kinds) if k == _NORMAL]
    for number, (text, kind) in enumerate(zip(pieces.texts, pieces.kinds)):
        spelled.append(b"")
        if kind == _BYTE:
            byte_ids[int(text[3:5], 16)] = number
            spelled[-1] = bytes([int(text[3:5], 16)])
        elif kind in (_NORMAL, _USER):
            spelled[-1] = text.replace(MARKER, " ").encode()
            words[spelled[-1]] = number
            if kind == _USER:
                scores[number] = len(text.encode()) * max(normal) - 0.1
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    apart = np.ones(256, dtype=bool)
    apart[128:] = apart[32] = False
    for word in words:
        if len(word) > 1:
            apart[list(word)] = False
    by_word = all(b" " not in word.lstrip(b" ") for word in words)
    return UnigramModel(
        Trie(words), scores, min(normal) - UNKNOWN_PENALTY, byte_ids, spelled, by_word, apart
    )


def _char_bytes(first: np.ndarray) -> np.ndarray:
    return 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)


def _cut_together(model: UnigramModel, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word, right-aligned, and how many; ``words`` has a row of bytes for each."""
    n, width = words.shape
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0.0
    came = np.zeros((n, width + 1), dtype=np.int32)
    by = np.full((n, width + 1), -1, dtype=np.int32)
    trie, every = model.trie, np.arange(n)
    for start in range(width):
        rows = every[(lengths > start) & (best[:, start] > -np.inf)]
        if not len(rows):
            continue
        size = _char_bytes(words[rows, start])
        bare = np.ones(n, dtype=bool)  # no piece spells the one character
        from_here = best[:, start]
        state, live = np.zeros(len(rows), dtype=np.int64), rows
        for at in range(start, width):
            inside = lengths[live] > at
            live, state, size = live[inside], state[inside], size[inside]
            if not len(live):
                break
            after = trie.base[state] + words[live, at].astype(np.int64)
            goes = (trie.check[after] == state) & (after > 0)
            live, state, size = live[goes], after[goes], size[goes]
            piece = trie.piece[state]
            ends = piece >= 0
            if ends.any():
                row, number = live[ends], piece[ends]
                bare[row[size[ends] == at + 1 - start]] = False
                score = from_here[row] + model.scores[number]
                more = score > best[row, at + 1]
                row, number = row[more], number[more]
                best[row, at + 1], came[row, at + 1], by[row, at + 1] = score[more], start, number
        row = rows[bare[rows]]
        if len(row):
            end = np.minimum(start + _char_bytes(words[row, start]), lengths[row])
            score = from_here[row] + model.unknown
            more = score > best[row, end]
            row, end = row[more], end[more]
            best[row, end], came[row, end], by[row, end] = score[more], start, -1
    out = np.zeros((n, width), dtype=np.int32)
    counts, at = np.zeros(n, dtype=np.int64), lengths.astype(np.int64).copy()
    rows = every[at > 0]
    while len(rows):
        number = by[rows, at[rows]]
        spelt = number < 0  # within an unknown character each byte is a step
        byte = model.byte_ids[words[rows, at[rows] - 1]]
        counts[rows] += 1
        out[rows, width - counts[rows]] = np.where(spelt, byte, number)
        at[rows] = np.where(spelt, at[rows] - 1, came[rows, at[rows]])
        rows = rows[at[rows] > 0]
    return out, counts


def _cut_alone(model: UnigramModel, word: bytes) -> list[int]:
    """The same for one word, however long."""
    base, check, piece = model.trie.base, model.trie.check, model.trie.piece
    n = len(word)
    best, came, by = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    for start in range(n):
        here = best[start]
        if here == -np.inf:
            continue
        first = word[start]
        size = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
        state, bare = 0, True
        for at in range(start, n):
            after = base[state] + word[at]
            if check[after] != state or after <= 0:
                break
            state = after
            number = piece[state]
            if number >= 0:
                bare &= at + 1 - start != size
                score = here + model.scores[number]
                if score > best[at + 1]:
                    best[at + 1], came[at + 1], by[at + 1] = score, start, int(number)
        end = min(start + size, n)
        if bare and here + model.unknown > best[end]:
            best[end], came[end], by[end] = here + model.unknown, start, -1
    out, at = [], n
    while at > 0:
        if by[at] < 0:
            out.append(int(model.byte_ids[word[at - 1]]))
            at -= 1
        else:
            out.append(by[at])
            at = came[at]
    return out[::-1]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers from each start on, as many as its length."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def encode_block(model: UnigramModel, block: A.Block) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block, one after the other, and where each text's begin."""
    marker = MARKER.encode()
    texts = [
        (b" " + block.data[s:e].tobytes()).replace(marker, b" ") if e > s else b""
        for s, e in zip(block.starts, block.ends)
    ]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    text_at = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[text_at] = True
    if model.by_word:
        space = data == 32
        begins[1:-1] |= space[1:] & ~space[:-1]
        apart = np.flatnonzero(model.apart[data])
        begins[apart] = begins[apart + 1] = True
    starts = np.flatnonzero(begins[:-1])
    lengths = np.diff(np.append(starts, len(data)))
    hashes = A.span_hashes(data, starts, starts + lengths)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)

    ids: list[np.ndarray] = []
    counts = np.zeros(len(first), dtype=np.int64)
    order = np.argsort(lengths[first], kind="stable")
    sorted_lengths = lengths[first][order]
    at = 0
    while at < len(order):
        size = int(sorted_lengths[at])
        if size > LONG_WORD:
            a = starts[first[order[at]]]
            own = np.array(_cut_alone(model, data[a : a + size].tobytes()), dtype=np.int32)
            ids.append(own)
            counts[at] = len(own)
            at += 1
            continue
        width = min(LONG_WORD, size + size // 8)
        end = min(int(np.searchsorted(sorted_lengths, width, side="right")), at + 1 + TOGETHER // width)
        chosen = order[at:end]
        own_lengths = sorted_lengths[at:end]
        width = int(own_lengths[-1])
        spots = np.minimum(starts[first[chosen]][:, None] + np.arange(width), len(data) - 1)
        out, number = _cut_together(model, data[spots], own_lengths)
        ids.append(out[np.arange(width)[None, :] >= width - number[:, None]])
        counts[at:end] = number
        at = end
    flat = np.concatenate(ids)
    begin_of = np.concatenate([[0], np.cumsum(counts)])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    word = rank[which]
    bounds = np.concatenate([[0], np.cumsum(counts[word])])
    return flat[_ranges(begin_of[word], counts[word])], bounds[np.searchsorted(starts, text_at)]


def decode_ids(model: UnigramModel, ids: list[int]) -> bytes:
    """The bytes that the pieces spell, without the marker that stands before the text."""
    text = b"".join(map(model.spelled.__getitem__, ids))
    return text[1:] if text[:1] == b" " else text


def encode(documents: DataFrame, model_path: str, column: str = "text") -> DataFrame:
    """doc_id and ids for every row of ``documents``, and round_trip: whether the ids spell the text.

    ``model_path`` is read on the driver and broadcast. A null or empty text has no ids. A marker character
    in a text counts as a space and comes back as one; all else comes back as it was. Rows that repeat a
    doc_id are encoded one by one; other columns are ignored.
    """
    with open(model_path, "rb") as source:
        shared = documents.sparkSession.sparkContext.broadcast(load_model(source.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for block in A.blocks(batch.column("text"), BLOCK_BYTES):
                ids, bounds = encode_block(model, block)
                listed = ids.tolist()
                same = [
                    decode_ids(model, listed[a:b]) == block.data[s:e].tobytes()
                    for a, b, s, e in zip(bounds, bounds[1:], block.starts, block.ends)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, len(block)),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(same),
                    ],
                    names=["doc_id", "ids", "round_trip"],
                )
            A.give_back()

    schema = T.StructType(
        [documents.schema["doc_id"], *T.StructType.fromDDL("ids array<int>, round_trip boolean").fields]
    )
    return documents.select("doc_id", F.col(column).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text for every row of ``encoded`` (doc_id, ids); null ids give a null text.

    Control pieces spell nothing; bytes that make no character become U+FFFD.
    """
    with open(model_path, "rb") as source:
        shared = encoded.sparkSession.sparkContext.broadcast(load_model(source.read()))

    @F.pandas_udf("string")
    def spell(column):
        model = shared.value
        return column.map(
            lambda ids: None if ids is None else decode_ids(model, list(ids)).decode(errors="replace")
        )

    return encoded.select("doc_id", spell("ids").alias("text"))
