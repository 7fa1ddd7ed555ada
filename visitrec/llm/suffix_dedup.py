"""Repeated passages: every byte that a string of ``length`` bytes covers which also starts anywhere else.

1. Each start of a string belongs to the anchor of its string: the least hash of the ``gram``-byte pieces in it.
   Equal strings have equal anchors. Neighbouring starts with one anchor make a segment of the text.
2. An anchor that occurs once in the corpus has no repeated string; those are most, and go. Occurrences are
   counted with partial sums.
3. Segments that are equal as a whole are copies: all their starts are repeated, and nobody need look inside.
4. One segment of each other content goes to the shard of its anchor. A shard's suffix array is built by induced
   sorting; neighbours in it that share a prefix of ``length`` bytes are repeated starts.
5. The bytes covered by repeated starts leave each text.

Contents of an anchor that has more than ``HOT`` of them are not gathered in one shard: their strings are counted
one by one, with partial sums. Texts without any candidate never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.llm import arrays as A
from visitrec.llm.bitmap import bitmap_of, may_hold
from visitrec.llm.suffix_arrays import repeated_starts
from visitrec.storage import Scratch

LENGTH, GRAM = 200, 50
#: Bytes of the segments in one suffix array.
SHARD_BYTES = 1 << 20
#: Contents of one anchor that a shard takes.
HOT = 20_000

_SEGMENT = "num long, key long, at int, starts int, anchor long, content long, occurs int"
_SPAN = "num long, key long, start int, end int"


def _keys() -> list[Column]:
    """Two numbers that tell a row from rows with another doc_id or text; equal rows share them."""
    number = F.coalesce(F.expr("try_cast(doc_id AS long)"), F.xxhash64("doc_id"))
    return [number.alias("num"), F.xxhash64("text").alias("key")]


def _segments(length: int, gram: int):
    width = length - gram + 1

    def cut(block: A.Block) -> tuple[np.ndarray, ...] | None:
        if len(block.data) < length:
            return None
        roll = A.Rolling(block.data, A.BYTE_CODES)
        starts = np.arange(len(block.data) - gram + 1)
        hashes = roll.of(starts, starts + gram)
        least = A.sliding_min(hashes, width)
        long = np.flatnonzero(block.ends - block.starts >= length)
        begins, ends = block.starts[long], block.ends[long] - length + 1  # of the starts in each text
        if not len(long):
            return None
        edge = np.zeros(len(least) + 1, dtype=np.int64)
        edge[begins] += 1
        edge[ends] -= 1
        inside = np.cumsum(edge[:-1]) > 0
        fresh = np.append(True, least[1:] != least[:-1])
        fresh[begins] = True
        at = np.flatnonzero(fresh & inside)
        owner = np.searchsorted(begins, at, side="right") - 1
        count = np.minimum(np.append(at[1:], len(least)), ends[owner]) - at
        # where an anchor itself occurs: hashes that are the least of some window over them
        border = np.zeros(width - 1, dtype=np.uint64)
        spots = np.flatnonzero(
            A.sliding_max(np.concatenate([border, least, border]), width) == hashes
        )
        low = np.searchsorted(spots, at)
        many = np.searchsorted(spots, at + count + width - 1) - low
        total = np.concatenate([[0], np.cumsum(many)])
        spot = spots[np.arange(total[-1]) + np.repeat(low - total[:-1], many)]
        own = hashes[spot] == np.repeat(least[at], many)
        occurs = np.diff(np.concatenate([[0], np.cumsum(own)])[total])
        content = A.span_hashes(block.data, at, at + count + length - 1)
        return long[owner], at - begins[owner], count, least[at], content, occurs

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in A.blocks(batch.column("text")):
                if (found := cut(block)) is None:
                    continue
                row, at, count, anchor, content, occurs = found
                row = pa.array(row + block.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("num").take(row),
                        batch.column("key").take(row),
                        pa.array(at.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        A.signed(anchor),
                        A.signed(content),
                        pa.array(occurs.astype(np.int32)),
                    ],
                    names=["num", "key", "at", "starts", "anchor", "content", "occurs"],
                )

    return scan


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Bytes that the strings at these starts cover."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(r[0]), int(r[-1]) + length) for r in np.split(starts, breaks)]


def _shards(length: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            spans = [
                (num, key, at + a, at + b)
                for (num, key, at, copies, _), found in zip(held, repeated_starts([h[4] for h in held], length))
                if copies == 1
                for a, b in _runs(found, length)
            ]
            columns = list(zip(*spans)) or [(), (), (), ()]
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["num", "key", "start", "end"]
            )

        names = ("num", "key", "at", "copies", "segment", "anchor")
        for batch in batches:
            for *row, anchor in zip(*(batch.column(c).to_pylist() for c in names)):
                if anchor != last and size >= SHARD_BYTES:  # an anchor's segments stay together
                    yield flush()
                    held, size = [], 0
                held.append(tuple(row))
                size += len(row[4])
                last = anchor
        if held:
            yield flush()

    return sort


def _strings(length: int):
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("num", "key", "at", "copies", "segment")
        for batch in batches:
            for num, key, at, copies, segment in zip(*(batch.column(c).to_pylist() for c in names)):
                data = np.frombuffer(segment, np.uint8)
                starts = np.arange(len(data) - length + 1)
                one = A.Rolling(data, A.BYTE_CODES).of(starts, starts + length)
                two = A.Rolling(data, A.mix(A.BYTE_CODES)).of(starts, starts + length)
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, num)),
                        pa.array(np.full(n, key)),
                        pa.array((at + starts).astype(np.int32)),
                        pa.array(np.full(n, copies, dtype=np.int64)),
                        A.signed(one),
                        A.signed(two),
                    ],
                    names=["num", "key", "start", "copies", "one", "two"],
                )

    return spell


def _sift(wanted):
    """Pass the text of rows that may be among the wanted ones; of others only what is needed at the end."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            may = may_hold(wanted.value, batch.column("hash").to_numpy().view(np.uint64))
            data, bounds = A.text_bytes(batch.column("text"))
            cuts = bounds.tolist()
            digests = [
                None if m else hashlib.sha256(data[a:b]).hexdigest()
                for m, a, b in zip(may.tolist(), cuts, cuts[1:])
            ]
            texts = [bytes(data[a:b]) if m else None for m, a, b in zip(may.tolist(), cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("num"),
                    batch.column("key"),
                    pa.array(np.diff(bounds)),
                    pa.array(digests, pa.string()),
                    pa.array(texts, pa.binary()),
                ],
                names=["doc_id", "num", "key", "n_bytes", "digest", "data"],
            )

    return scan


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, counts, digests, texts = [], [], [], []
        names = ("digest", "data", "spans")
        for digest, data, spans in zip(*(batch.column(c).to_pylist() for c in names)):
            runs = _joined([(s["start"], s["end"]) for s in spans or []])
            removed.append(sum(b - a for a, b in runs))
            counts.append(len(runs))
            if digest is None:
                edges = [0, *(e for run in runs for e in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                digest = hashlib.sha256(kept).hexdigest()
                texts.append(kept if runs else None)
            else:
                texts.append(None)
            digests.append(digest)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_bytes"),
                pa.array(removed, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(texts, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Take out of every text the bytes that a repeated string of ``length`` bytes covers.

    Texts are UTF-8 bytes; strings never cross texts, may overlap each other, and are judged on the input.
    Returns for each row of ``documents`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 and kept (the remaining bytes; null where nothing was removed). A null text is empty. Rows
    that repeat a text, with one doc_id or several, repeat each other's strings. Other columns are ignored.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "repeats")
    id_field = documents.schema["doc_id"]
    rows = documents.select("doc_id", "text", *_keys())
    texts = rows.filter(F.octet_length("text") >= length).select("num", "key", "text")
    cut = scratch.keep(texts.mapInArrow(_segments(length, gram), _SEGMENT), "segments")
    anchors = scratch.keep(
        cut.groupBy("anchor")
        .agg(
            F.sum("occurs").alias("total"),
            F.min("content").alias("low"),
            F.max("content").alias("high"),
        )
        .filter("total > 1")
        .select("anchor", (F.col("low") == F.col("high")).alias("single")),
        "anchors",
    )
    members = scratch.keep(cut.join(anchors, "anchor"), "members")
    scratch.drop("segments")
    contents = scratch.keep(
        members.groupBy("anchor", "content", "single", "starts").agg(
            F.count(F.lit(1)).alias("copies"),
            F.max("occurs").alias("occurs"),
            F.min_by("num", "key").alias("num"),
            F.min("key").alias("key"),
            F.min_by("at", "key").alias("at"),
        ),
        "contents",
    )
    copied = contents.filter("copies > 1").select("anchor", "content", "starts")
    whole = members.join(copied, ["anchor", "content", "starts"]).select(
        "num", "key", F.col("at").alias("start"), (F.col("at") + F.col("starts") + length - 1).alias("end")
    )
    # a single content may still repeat strings inside itself, if its anchor occurs in it twice
    open_ = contents.filter("NOT single OR (copies = 1 AND occurs > 1)")
    found = _repeats_between(scratch, rows, open_, length)
    spans = scratch.keep(whole.union(found), "spans")

    per_row = spans.groupBy("num", "key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    wanted = bitmap_of(spans, F.xxhash64("num", "key"))
    sifted = rows.withColumn("hash", F.xxhash64("num", "key")).mapInArrow(
        _sift(wanted),
        T.StructType(
            [id_field, *T.StructType.fromDDL("num long, key long, n_bytes long, digest string, data binary").fields]
        ),
    )
    # null keys stand for null texts, which have no spans
    return sifted.join(per_row, ["num", "key"], "left").select(
        "doc_id", "n_bytes", "digest", "data", "spans"
    ).mapInArrow(
        _removed,
        T.StructType(
            [
                id_field,
                *T.StructType.fromDDL(
                    "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
                ).fields,
            ]
        ),
    )


def _repeats_between(scratch: Scratch, rows: DataFrame, contents: DataFrame, length: int) -> DataFrame:
    """Spans of repeated strings in segments whose content occurs once."""
    crowds = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("crowd"))
    hot = scratch.keep(crowds.filter(F.col("crowd") > HOT).select("anchor"), "hot")
    wanted = bitmap_of(contents, F.xxhash64("num", "key"))
    texts = (
        rows.withColumn("hash", F.xxhash64("num", "key"))
        .select("doc_id", "num", "key", "hash", "text")
        .mapInArrow(
            _sift(wanted),
            T.StructType(
                [
                    rows.schema["doc_id"],
                    *T.StructType.fromDDL("num long, key long, n_bytes long, digest string, data binary").fields,
                ]
            ),
        )
        .filter("data IS NOT NULL")
        .select("num", "key", "data")
        .dropDuplicates(["num", "key"])
    )
    segment = F.substring(F.col("data"), F.col("at") + 1, F.col("starts") + length - 1)
    segments = (
        contents.select("num", "key", "at", "starts", "copies", "anchor")
        .join(texts, ["num", "key"])
        .select("num", "key", "at", "copies", "anchor", segment.alias("segment"))
    )
    segments = scratch.keep(segments, "open")
    order = ["anchor", "num", "key", "at"]
    found = (
        segments.join(hot, "anchor", "left_anti")
        .repartition("anchor")
        .sortWithinPartitions(*order)
        .mapInArrow(_shards(length), _SPAN)
    )
    if hot.isEmpty():
        return found
    strings = scratch.keep(
        segments.join(hot, "anchor", "left_semi").mapInArrow(
            _strings(length), "num long, key long, start int, copies long, one long, two long"
        ),
        "strings",
    )
    twice = scratch.keep(
        strings.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("one", "two"),
        "twice",
    )
    single = strings.filter("copies = 1").join(twice, ["one", "two"], "left_semi")
    return found.union(
        single.select("num", "key", "start", (F.col("start") + length).cast("int").alias("end"))
    )
