"""Files whose records may hold their own separators, cut by many tasks and read once.

A task cannot see whether its split of a file begins inside a quoted cell, a JSON string or an object. So:

1. Each task reads its splits once and stores them as chunks of about ``CHUNK_BYTES``. For both cases, beginning outside
   quotes or inside, it notes the state (in quotes or not, change of depth) at the start and end of every chunk.
2. A prefix scan over the splits of each file, one small row for each, says in which state every split begins.
3. Chunks are cut into records from the state that is now known. What crosses the end of a chunk is put together.

The driver holds a row for each split and hands out those that begin inside a record: some 100 bytes for
``spark.sql.files.maxPartitionBytes`` of input, 80 MB for 100 TB in splits of 128 MB.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitrec.storage import Scratch

CHUNK_BYTES = 1 << 20

#: Inside quotes or not, and how many braces are open.
State = tuple[bool, int]


@dataclass(frozen=True)
class Format:
    """How records are told apart. ``separator`` cuts a file into pieces that are read as lines."""

    separator: str
    quoted: re.Pattern[bytes]
    quoted_rest: re.Pattern[bytes]
    nested: bool

    def quotes(self, text: bytes, inside: bool) -> tuple[np.ndarray, bool]:
        """Start and end of every quoted stretch, and whether the last one is open at the end."""
        found = _json_quotes(text, inside) if self.nested else None
        if found is not None:
            return found
        if b'"' not in text:
            return np.array([[0, len(text)]] * inside, dtype=np.int64).reshape(-1, 2), inside
        spans, at = [], 0
        if inside:
            match = self.quoted_rest.match(text)
            spans.append(match.span())
            inside, at = not match[1], match.end()
        if not inside:
            for match in self.quoted.finditer(text, at):
                spans.append(match.span())
                inside = not match[1]
        return np.array(spans, dtype=np.int64).reshape(-1, 2), inside

    def outside(self, text: bytes, spans: np.ndarray, members: bytes) -> np.ndarray:
        """Where these bytes stand outside quotes."""
        data = np.frombuffer(text, np.uint8)
        at = np.flatnonzero(np.logical_or.reduce([data == member for member in members]))
        if len(spans):
            last = np.searchsorted(spans[:, 0], at, side="right") - 1
            at = at[(last < 0) | (at >= spans[np.maximum(last, 0), 1])]
        return at

    def levels(self, text: bytes, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of braces, and the depth after each, from 0."""
        at = self.outside(text, spans, b"{}")
        steps = np.where(np.frombuffer(text, np.uint8)[at] == ord("{"), 1, -1)
        return at, np.cumsum(steps)

    def after(self, text: bytes, inside: bool) -> State:
        """The state at the end, depth counted from the start."""
        spans, ends_inside = self.quotes(text, inside)
        levels = self.levels(text, spans)[1] if self.nested else ()
        return ends_inside, int(levels[-1]) if len(levels) else 0

    def cut(self, text: bytes, state: State, whole: bool = True) -> tuple[bytes | None, list[bytes], bytes | None]:
        """The end of a record that began before, the records in between, the beginning of one that goes on.

        Who wants none of those in between passes ``whole=False``.
        """
        spans, ends_inside = self.quotes(text, state[0])
        return (self._objects if self.nested else self._rows)(text, spans, state, ends_inside, whole)

    def _rows(self, text, spans, state, ends_inside, whole):
        bounds = self.outside(text, spans, b"\n").tolist()
        edges = [-1, *bounds, len(text)]
        parts = [text[a + 1 : b] for a, b in zip(edges, edges[1:])]
        head = parts.pop(0) if state[0] else None
        tail = parts.pop() if ends_inside and parts else None
        return head, [part for part in parts if part.strip()], tail

    def _objects(self, text, spans, state, ends_inside, whole):
        at, levels = self.levels(text, spans)
        levels = levels + state[1]
        before = np.concatenate([[state[1]], levels[:-1]]) if len(levels) else levels
        if (levels < 0).any() or (state[0] and not state[1]):
            raise ValueError("malformed JSON: a brace or quote too many")
        opens = at[(before == 0) & (levels == 1)].tolist()
        closes = at[(before == 1) & (levels == 0)].tolist()
        head, tail, first = None, None, 0
        if state[1]:
            first = closes.pop(0) + 1 if closes else len(text)
            head = text[:first]
        if not whole:
            return head, [], text[opens[-1] :] if len(opens) > len(closes) else None
        records, gaps = [], []
        for a, b in zip(opens, closes):
            gaps.append(text[first:a])
            records.append(text[a : b + 1])
            first = b + 1
        if len(opens) > len(closes):
            gaps.append(text[first : opens[-1]])
            tail = text[opens[-1] :]
        else:
            gaps.append(text[first:])
        for gap in gaps:
            if gap != b"," and gap.strip(b" \t\r\n,[]"):
                raise ValueError(f"malformed JSON: {gap[:40]!r} between records")
        return head, records, tail


def _json_quotes(text: bytes, inside: bool) -> tuple[np.ndarray, bool] | None:
    """What ``Format.quotes`` finds, for a whole chunk at once; None where a quote is escaped outside quotes."""
    data = np.frombuffer(text, np.uint8)
    at = np.flatnonzero(data == ord('"'))
    escaped = at[:0]
    if len(slashes := np.flatnonzero(data == ord("\\"))):
        # an odd number of backslashes escapes the quote that follows them
        last = np.append(slashes[1:] != slashes[:-1] + 1, True)
        ends = np.flatnonzero(last)
        counts = np.diff(ends, prepend=-1)
        after = slashes[ends[counts % 2 == 1]] + 1
        escaped = np.intersect1d(at, after, assume_unique=True)
        at = np.setdiff1d(at, escaped, assume_unique=True)
    if inside:
        starts, ends = np.append(0, at[1::2]), at[0::2] + 1
    else:
        starts, ends = at[0::2], at[1::2] + 1
    ends_inside = len(starts) > len(ends)
    if ends_inside:
        ends = np.append(ends, len(text))
    if len(escaped):
        span = np.searchsorted(starts, escaped, side="right") - 1
        if (span < 0).any() or (escaped >= ends[span]).any():
            return None
    return np.stack([starts, ends], axis=1).astype(np.int64), ends_inside


#: Cells may be quoted, with doubled quotes inside; a quote elsewhere in a cell is a character like any other.
CSV = Format(
    "\n",
    re.compile(rb'(?:(?<=[,\n])|\A)[ \t]*"[^"]*(?:""[^"]*)*("?)'),
    re.compile(rb'[^"]*(?:""[^"]*)*("?)'),
    nested=False,
)
#: Objects of an array, or one after the other. No text is without braces for long, so they are the pieces' ends.
JSON = Format(
    "{",
    re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*("?)', re.S),
    re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*("?)', re.S),
    nested=True,
)

_BOM = b"\xef\xbb\xbf"
_CHUNK = (
    "file string, start long, chunk int, ends boolean, content binary, first binary, last binary, in_0 boolean, depth_0 int, in_1 boolean,"
    " depth_1 int, after_in_0 boolean, after_depth_0 int, after_in_1 boolean, after_depth_1 int"
)


def _chunks(form: Format, size: int):
    """The pieces of each split, put together again, with the states of both cases."""
    separator = form.separator.encode()

    class Split:
        def __init__(self, file: str, start: int) -> None:
            self.file, self.start, self.number = file, start, 0
            self.pieces: list[bytes] = []  # each of them several, put together
            self.bytes = 0
            self.states: list[State] = [(False, 0), (True, 0)]

        def row(self, ends: bool) -> list:
            text = separator.join(self.pieces)
            if self.start == 0 and self.number == 0:
                text = text.removeprefix(_BOM)
            else:
                text = separator + text
            before, after = self.states, []
            known: dict[bool, State] = {}
            for inside, depth in before:
                if inside not in known:
                    known[inside] = form.after(text, inside)
                after.append((known[inside][0], depth + known[inside][1]))
            shown = text.strip(b" \t\r\n")
            edges = [shown[:1], shown[-1:]] if text else [None, None]
            out = [self.file, self.start, self.number, ends, text, *edges, *before[0], *before[1], *after[0], *after[1]]
            self.states, self.pieces, self.bytes = after, [], 0
            self.number += 1
            return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            rows, n = [], batch.num_rows
            if not n:
                continue
            files, starts, values = (batch.column(c) for c in ("file", "start", "value"))
            moved = pc.or_(*(pc.not_equal(c.slice(1), c.slice(0, n - 1)) for c in (files, starts)))
            edges = [0, *(np.flatnonzero(moved.to_numpy(zero_copy_only=False)) + 1).tolist(), n]
            upto = np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy() + 1, dtype=np.int64)])
            for a, b in zip(edges, edges[1:]):
                file, start = files[a].as_py(), starts[a].as_py()
                if split is None or (file, start) != (split.file, split.start):
                    if split:
                        rows.append(split.row(True))
                    split = Split(file, start)
                while a < b:
                    if split.bytes >= size:
                        rows.append(split.row(False))
                    # as many pieces as it takes to reach the size
                    c = min(b, int(np.searchsorted(upto, upto[a] + size - split.bytes)))
                    split.pieces.append(_joined(values.slice(a, c - a), separator))
                    split.bytes += int(upto[c] - upto[a])
                    a = c
            if rows:
                yield _batch(rows)
        if split:
            yield _batch([split.row(True)])

    return scan


def _joined(pieces: pa.Array, separator: bytes) -> bytes:
    whole = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)
    return pc.binary_join(whole, pa.scalar(separator, pieces.type))[0].as_py()


_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
_FIELDS = [part.split() for part in _CHUNK.split(", ")]


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), _KINDS[kind]) for values, (_, kind) in zip(zip(*rows), _FIELDS)],
        names=[name for name, _ in _FIELDS],
    )


class SplitText:
    """Files in a stored form from which records are cut in parallel. Compressed files are one split each."""

    def __init__(
        self, spark: SparkSession, path: str | Sequence[str], form: Format, chunk_bytes: int = CHUNK_BYTES
    ) -> None:
        self.form = form
        self.scratch = Scratch(spark, "split-text")
        pieces = spark.read.option("lineSep", form.separator).text(path if isinstance(path, str) else list(path))
        pieces = pieces.select(
            F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
        self.stored = self.scratch.keep(pieces.mapInArrow(_chunks(form, chunk_bytes), _CHUNK), "chunks")
        # a row for each split
        splits = self.stored.filter("ends").drop("content", "first", "last", "chunk", "ends").collect()
        states: dict[tuple[str, int], State] = {}
        state: State = (False, 0)
        for row in sorted(splits, key=lambda r: (r["file"], r["start"])):
            if row["start"] == 0:
                state = (False, 0)
            if state != (False, 0):
                states[row["file"], row["start"]] = state
            case = int(state[0])
            state = (row[f"after_in_{case}"], state[1] + row[f"after_depth_{case}"])
        self.states = spark.sparkContext.broadcast(states)
        self.crossing: DataFrame | None = None

    def _resolved(self, cut: Callable[[dict, bytes, State], Iterator[list]], names: list[str], kinds: list[pa.DataType]):
        states = self.states

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk in batch.to_pylist():
                    inside, depth = states.value.get((chunk["file"], chunk["start"]), (False, 0))
                    case = int(inside)
                    state = (chunk[f"in_{case}"], depth + chunk[f"depth_{case}"])
                    rows = list(cut(chunk, chunk["content"], state))
                    if rows:
                        columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
                        yield pa.RecordBatch.from_arrays(columns, names=names)

        return scan

    def first_records(self) -> DataFrame:
        """file and record: the first record of every file that has one."""
        form = self.form

        def first(chunk: dict, text: bytes, state: State) -> Iterator[list]:
            _, records, tail = form.cut(text, state)
            if records or tail:
                yield [chunk["file"], records[0] if records else tail]

        return self.stored.filter("start = 0 AND chunk = 0").mapInArrow(
            self._resolved(first, ["file", "record"], [pa.string(), pa.binary()]), "file string, record binary"
        )

    def records(self, skip_first: bool = False) -> DataFrame:
        """file and record (text) of all records; without the first of each file where ``skip_first`` is set."""
        form = self.form

        def whole(chunk: dict, text: bytes, state: State) -> Iterator[list]:
            records = form.cut(text, state)[1]
            skipped = skip_first and chunk["start"] == 0 and chunk["chunk"] == 0
            yield from ([chunk["file"], record] for record in records[int(skipped) :])

        def parts(chunk: dict, text: bytes, state: State) -> Iterator[list]:
            head, _, tail = form.cut(text, state, whole=False)
            place = [chunk["file"], chunk["start"], chunk["chunk"]]
            if head is not None:
                yield [*place, False, head]
            if tail is not None:
                yield [*place, True, tail]

        complete = self.stored.mapInArrow(
            self._resolved(whole, ["file", "record"], [pa.string(), pa.binary()]), "file string, record binary"
        )
        return complete.union(self._crossing(parts)).select("file", F.col("record").cast("string").alias("record"))

    def _crossing(self, parts: Callable[[dict, bytes, State], Iterator[list]]) -> DataFrame:
        """Records over several chunks, put together and stored; there are fewer of them than chunks."""
        if self.crossing is not None:
            return self.crossing
        names = ["file", "start", "chunk", "begins", "part"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
        crossing = self.stored.mapInArrow(
            self._resolved(parts, names, kinds), "file string, start long, chunk int, begins boolean, part binary"
        )
        # at most two parts for each chunk; a record is a beginning and what follows up to the next one
        place = Window.partitionBy("file").orderBy("start", "chunk", "begins")
        numbered = crossing.withColumn("record_number", F.sum(F.col("begins").cast("long")).over(place))
        ordered = F.array_sort(F.collect_list(F.struct("start", "chunk", "begins", "part")))
        joined = F.aggregate(
            F.transform(ordered, lambda x: x["part"]), F.lit(b""), lambda text, part: F.concat(text, part)
        )
        rejoined = numbered.groupBy("file", "record_number").agg(joined.alias("record")).select("file", "record")
        self.crossing = self.scratch.keep(rejoined, "crossing")
        return self.crossing
