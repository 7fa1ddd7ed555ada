"""Document fingerprints: MinHash over word shingles, and the near-duplicates they lead to.

A fingerprint holds, for each of ``BANDS * ROWS`` universal hash permutations (multiplication by an odd number and an
addition, modulo 2**64), the least hash of a text's shingles, cut to 16 bits. The share of equal places in two
fingerprints estimates the Jaccard similarity of the shingle sets.

Near-duplicates: texts with equal sets form a class. Each class is dealt to a bucket for each band of its signature. In
a bucket one class, the least in a random order, meets all others; where the exact similarity of the sets
reaches the threshold they are linked, and links make components. Buckets that still hold several components go through
it again with ``LEADERS`` other classes, until a round finds few links. These rounds compare a pair only if one bit of
each of its 125 places allows the similarity (five standard deviations). What they have left is then compared whole: all
pairs of a bucket that lie in different components, but for those whose sizes or parity maps prove them too different,
so no two texts that share a bucket are left out. With 25 bands of 5 rows, two texts of similarity 0.8 share eight
buckets on average and none in one case of 20,000.

Editions: documents in order of their ids are dealt by ranges of ids, sorted by Spark, and read as a stream in which each
meets the next one. The first document of a range stands once more at the end of the range before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from visitrec.llm import arrays as A
from visitrec.llm.bitmap import bitmap_of, may_hold
from visitrec.llm.components import components
from visitrec.storage import Scratch

SHINGLE, BANDS, ROWS, THRESHOLD = 5, 25, 5, (80, 100)
PERMUTATIONS = BANDS * ROWS
#: Classes of a bucket that meet the others, from the second round on.
LEADERS = 3
#: A round that finds fewer links than a class in so many has the last one follow it, in which all pairs meet.
FEW = 100
#: Least bits of a set's parity map.
PARITY_BITS = 256
#: Places in which one bit of two signatures may differ: a tenth of them at the threshold, and five deviations more.
MOST_BITS = int(PERMUTATIONS * 0.1 + 5 * (PERMUTATIONS * 0.09) ** 0.5)
#: Documents of a range, and the most ranges there are; the driver holds one id for each.
RANGE_ROWS, MOST_RANGES = 2000, 1 << 16
#: Partitions that the ranges are dealt to, at most.
MOST_PARTITIONS = 1 << 13
#: Bytes of text that a task fingerprints at once.
HELD_BYTES = 1 << 20

_FIRST_KEY = -(1 << 63)  # stands for a null id

_MULTIPLIERS = A.mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)
_ADDENDS = A.mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) << np.uint64(32))


def _shingles(block: A.Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles of a block, and where those of each text begin (one more for the end)."""
    words = A.words_of(block)
    hashes = A.span_hashes(A.folded(block.data), words.starts, words.ends)
    runs = A.run_hashes(hashes, n)
    counts = words.counts
    out, sizes = [], np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        if b - a >= n:
            out.append(runs[a : b - n + 1])
        elif b > a:
            out.append(A.run_hashes(hashes[a:b], b - a))
    flat = np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The least hash by each permutation, a row for each text; all ones for a text without shingles."""
    sizes = np.diff(bounds)
    full = np.flatnonzero(sizes)
    out = np.full((len(sizes), PERMUTATIONS), np.iinfo(np.uint64).max, dtype=np.uint64)
    if len(full):
        starts = bounds[full]
        hashed = np.empty_like(shingles)
        for i in range(PERMUTATIONS):
            np.multiply(shingles, _MULTIPLIERS[i], out=hashed)
            hashed += _ADDENDS[i]
            out[full, i] = np.minimum.reduceat(hashed, starts)
    return out


def _fingerprints(texts: list[str], n: int) -> np.ndarray:
    """A row of 16-bit numbers for each text."""
    rows = [
        (A.mix(_signatures(*_shingles(block, n))) & np.uint64(0xFFFF)).astype(">u2")
        for block in A.blocks(pa.array(texts, pa.large_string()))
    ]
    return np.concatenate(rows) if rows else np.zeros((0, PERMUTATIONS), dtype=">u2")


def likeness(one: str, two: str) -> float:
    """The share of equal places of two fingerprints in hexadecimal."""
    pairs = zip(*([text[i : i + 4] for i in range(0, len(text), 4)] for text in (one, two)))
    return sum(a == b for a, b in pairs) / PERMUTATIONS


# --- near-duplicates


def _scan_sets(n: int):
    """For each text: the size of its set, a signature of the set, and a hash for each band."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in A.blocks(batch.column("text")):
                shingles, bounds = _shingles(block, n)
                signatures = _signatures(shingles, bounds)
                bands = np.empty((len(block), BANDS), dtype=np.uint64)
                for b in range(BANDS):
                    own = signatures[:, b * ROWS : (b + 1) * ROWS]
                    bands[:, b] = A.mix(np.full(len(block), b + 1, dtype=np.uint64))
                    for column in range(ROWS):
                        bands[:, b] = A.mix(bands[:, b] ^ own[:, column])
                low_bits = np.zeros((len(block), 128), dtype=np.uint8)
                low_bits[:, :PERMUTATIONS] = (A.mix(signatures) & np.uint64(1)).astype(np.uint8)
                sketches = np.packbits(low_bits, axis=1).view(np.int64)
                sets = [np.unique(shingles[a:b]) for a, b in zip(bounds, bounds[1:])]
                marks = np.array(
                    [
                        [A.mix(s).sum(dtype=np.uint64), A.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)]
                        for s in sets
                    ],
                    dtype=np.uint64,
                ).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, len(block)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        A.signed(np.ascontiguousarray(marks[:, 0])),
                        A.signed(np.ascontiguousarray(marks[:, 1])),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(block) + 1) * BANDS, pa.int32()), A.signed(bands.ravel())
                        ),
                        pa.array(np.ascontiguousarray(sketches[:, 0])),
                        pa.array(np.ascontiguousarray(sketches[:, 1])),
                    ],
                    names=["doc_id", "n", "one", "two", "bands", "bits_1", "bits_2"],
                )
            A.give_back()

    return scan


def _parity(grams: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of the set's hashes fall on it; 1 to 2 bits for each. The halves of a map
    combined are the map of half as many bits. Two maps differ in no more bits than the sets in shingles."""
    bits = PARITY_BITS
    while bits < len(grams):
        bits *= 2
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _scan_wanted(n: int, wanted, maps: bool = False):
    """The sets of documents that may be among the wanted ones, or their sizes and parity maps."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.parts(batch):
                keys = part.column("key").to_numpy().view(np.uint64)
                part = part.filter(pa.array(may_hold(wanted.value, keys)))
                for block in A.blocks(part.column("text")):
                    shingles, bounds = _shingles(block, n)
                    sets = [np.unique(shingles[a:b]) for a, b in zip(bounds, bounds[1:])]
                    ids = part.column("doc_id").slice(block.first, len(block))
                    if maps:
                        columns = [ids, pa.array([len(s) for s in sets], pa.int64())]
                        columns.append(pa.array([_parity(s) for s in sets], pa.list_(pa.int64())))
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "parity"])
                        continue
                    ends = np.cumsum([0, *map(len, sets)])
                    flat = np.concatenate(sets) if sets else shingles
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), A.signed(flat))],
                        names=["doc_id", "grams"],
                    )
            A.give_back()

    return scan


def _differing(one: str, two: str) -> Column:
    """The bits in which two maps differ, one of them at most twice as long as the other."""
    size = F.least(F.size(one), F.size(two))

    def folded(name: str) -> Column:
        halves = F.slice(name, F.lit(1), size), F.slice(name, size + 1, size)
        both = F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(name) == 2 * size, both).otherwise(F.col(name))

    bits = F.zip_with(folded(one), folded(two), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, own: total + own)


class _Groups:
    def __init__(self, documents: DataFrame, n: int, threshold: tuple[int, int]) -> None:
        self.rows = documents.select("doc_id", "text").filter("doc_id IS NOT NULL")
        self.id = documents.schema["doc_id"]
        self.n, (self.num, self.den) = n, threshold
        self.scratch = Scratch(documents.sparkSession, "minhash")

    def _schema(self, ddl: str) -> T.StructType:
        return T.StructType([self.id, *T.StructType.fromDDL(ddl).fields])

    def run(self) -> DataFrame:
        """doc_id and component_id of documents whose component has a smaller id than their own."""
        keep = self.scratch.keep
        sets = keep(
            self.rows.mapInArrow(
                _scan_sets(self.n), self._schema("n long, one long, two long, bands array<long>, bits_1 long, bits_2 long")
            ).filter("n > 0"),
            "sets",
        )
        classes = keep(
            sets.groupBy("one", "two", "n").agg(
                F.min("doc_id").alias("class"),
                *(F.min_by(c, "doc_id").alias(c) for c in ("bands", "bits_1", "bits_2")),
            ),
            "classes",
        )
        dealt = classes.select("class", "n", "bits_1", "bits_2", F.explode("bands").alias("bucket"))
        shared = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        buckets = keep(dealt.join(shared.select("bucket"), "bucket"), "buckets")
        # every class that shares a bucket, with the least class that links have reached so far
        labels = keep(
            buckets.select(F.col("class").alias("node"), F.col("class").alias("component")).distinct(), "labels-0"
        )
        few = labels.count() // FEW
        step, last = 0, False
        while True:
            pairs = self._rest(buckets, labels) if last else self._pairs(buckets, labels, step)
            pairs = keep(pairs, f"pairs-{step}")
            found = self._links(pairs, f"links-{step}")
            links = found.count()
            if links:
                merged = components(found, self.scratch, f"components-{step}")
                merged = merged.select(F.col("node").alias("component"), F.col("component").alias("lower"))
                labels = labels.join(merged, "component", "left").select(
                    "node", F.coalesce("lower", "component").alias("component")
                )
                labels = keep(labels, f"labels-{step + 1}")
            self.scratch.drop(f"pairs-{step}")
            if last:
                break
            last = step > 0 and links <= few
            step += 1
        named = sets.select("doc_id", "one", "two", "n").join(
            classes.select("one", "two", "n", "class"), ["one", "two", "n"]
        )
        groups = (
            named.join(labels.withColumnRenamed("node", "class"), "class", "left")
            .select("doc_id", F.coalesce("component", "class").alias("component_id"))
            .filter("component_id < doc_id")
        )
        groups = keep(groups.groupBy("doc_id").agg(F.min("component_id").alias("component_id")), "groups")
        for label in ("sets", "classes", "buckets"):
            self.scratch.drop(label)
        return groups

    def _pairs(self, buckets: DataFrame, labels: DataFrame, step: int) -> DataFrame:
        """Classes to compare, a of some bucket's few and b: the likeliest one for b by their bits.

        At first one pair for each class, later one for each class and component that it may belong to.
        """
        rows = buckets.join(labels.select(F.col("node").alias("class"), F.col("component").alias("label")), "class")
        # one order for all buckets at first, so that a class meets the same few others in most of them
        ranks = [F.xxhash64("class")]
        if step:
            ranks = [F.xxhash64("class", "bucket", F.lit(step * LEADERS + i)) for i in range(LEADERS)]
        held = ("class", "n", "label", "bits_1", "bits_2")
        heads = (
            rows.groupBy("bucket")
            .agg(
                F.array(*(F.min(F.struct(rank.alias("rank"), *held)) for rank in ranks)).alias("heads"),
                F.min("label").alias("low"),
                F.max("label").alias("high"),
            )
            .filter("low < high")
            .select("bucket", F.explode(F.array_distinct("heads")).alias("head"))
            .select("bucket", *(F.col(f"head.{c}").alias(f"head_{c}") for c in held))
        )
        sizes = self.den * F.least("n", "head_n") >= self.num * F.greatest("n", "head_n")
        differ = [F.bit_count(F.col(c).bitwiseXOR(F.col(f"head_{c}"))) for c in ("bits_1", "bits_2")]
        met = (
            rows.join(heads, "bucket")
            .withColumn("differ", differ[0] + differ[1])
            .filter((F.col("label") != F.col("head_label")) & sizes & (F.col("differ") <= MOST_BITS))
        )
        likeliest = F.min(F.struct("differ", "head_class", "head_label")).alias("head")
        by = ["class", "label", "head_label"] if step else ["class", "label"]
        return (
            met.groupBy(*by)
            .agg(likeliest)
            .select(
                F.col("head.head_class").alias("a"),
                F.col("class").alias("b"),
                F.col("head.head_label").alias("a_label"),
                F.col("label").alias("b_label"),
            )
        )

    def _rest(self, buckets: DataFrame, labels: DataFrame) -> DataFrame:
        """All pairs of classes that share a bucket, lie in different components and may reach the threshold.

        Sizes and parity maps leave out only pairs that they prove too different.
        """
        rows = buckets.select("bucket", "class").join(
            labels.select(F.col("node").alias("class"), F.col("component").alias("label")), "class"
        )
        ends = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        mixed = self.scratch.keep(rows.join(ends.filter("low < high").select("bucket"), "bucket").distinct(), "mixed")
        wanted = bitmap_of(mixed.select("class").distinct(), F.xxhash64("class"))
        maps = self.rows.withColumn("key", F.xxhash64("doc_id")).mapInArrow(
            _scan_wanted(self.n, wanted, maps=True), self._schema("n long, parity array<long>")
        )
        maps = self.scratch.keep(maps.withColumnRenamed("doc_id", "class"), "maps")
        wanted.unpersist()
        rows = mixed.join(maps, "class")
        one, two = (
            rows.select("bucket", *(F.col(c).alias(f"{side}_{c}") for c in ("class", "label", "n", "parity")))
            for side in "ab"
        )
        total = F.col("a_n") + F.col("b_n")
        sizes = self.den * F.least("a_n", "b_n") >= self.num * F.greatest("a_n", "b_n")
        close = (self.num + self.den) * (total - _differing("a_parity", "b_parity")) >= 2 * self.num * total
        return (
            one.join(two, "bucket")
            .filter((F.col("a_label") < F.col("b_label")) & sizes & close)
            .select(F.col("a_class").alias("a"), F.col("b_class").alias("b"), "a_label", "b_label")
            .distinct()
        )

    def _links(self, pairs: DataFrame, label: str) -> DataFrame:
        """The components (a, b) of pairs whose sets reach the threshold, counted exactly."""
        nodes = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        wanted = bitmap_of(nodes, F.xxhash64("doc_id"))
        sets = self.rows.withColumn("key", F.xxhash64("doc_id")).mapInArrow(
            _scan_wanted(self.n, wanted), self._schema("grams array<long>")
        )
        sets = self.scratch.keep(sets, f"{label}-sets")
        wanted.unpersist()
        one = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("a_grams"))
        two = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("b_grams"))
        total = F.size("a_grams") + F.size("b_grams")
        both = F.size(F.array_intersect("a_grams", "b_grams"))
        reached = pairs.join(two, "b").join(one, "a").filter((self.num + self.den) * both >= self.num * total)
        links = reached.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).distinct()
        links = self.scratch.keep(links, label)
        self.scratch.drop(f"{label}-sets")
        return links


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """Which documents (doc_id, text) have a near-duplicate with a smaller id: doc_id, component_id.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; a text of fewer than ``shingle`` words is
    one shingle, one without words is linked with nothing. Texts link if ``den * intersection >= num * union``. The
    component_id is the least doc_id that links reach. Rows without an id are left out; those that share an id should
    hold one text. Other columns are ignored.
    """
    return _Groups(documents, shingle, threshold).run()


# --- editions


def _edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _editions(n: int, id_type: pa.DataType):
    """Rows of a range in order, each id's component before its documents, and the next range's first at the end."""

    def flush(held: list[tuple], following: str) -> pa.RecordBatch:
        texts = [text for _, text, _ in held]
        edited = [_edited(a, b) for a, b in zip(texts, [*texts[1:], following])]
        prints = _fingerprints([*texts, following], n)
        changed = _fingerprints(edited, n)
        own = prints[:-1]
        components = [None if i is None else i if c is None else c for i, _, c in held]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _, _ in held], id_type),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array([row.tobytes().hex() for row in own]),
                pa.array([row.tobytes().hex() for row in changed]),
                pa.array((own == changed).mean(axis=1), pa.float64()),
                pa.array((own == prints[1:]).mean(axis=1), pa.float64()),
                pa.array(components, id_type),
            ],
            names=_EDITION_NAMES,
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, label = 0, (None, None)
        names = ("kind", "doc_id", "text", "component")
        for batch in batches:
            for part in A.parts(batch):
                for kind, number, text, component in zip(*(part.column(c).to_pylist() for c in names)):
                    if kind == _LABEL:
                        label = (number, component)
                    elif kind == _NEXT_RANGE:
                        yield flush(held, text)
                        held, size = [], 0
                    else:
                        if size >= HELD_BYTES:
                            yield flush(held, text)
                            held, size = [], 0
                        held.append((number, text, label[1] if label[0] == number and number is not None else None))
                        size += len(text)
            A.give_back()

    return scan


_LABEL, _DOCUMENT, _NEXT_RANGE = 0, 1, 2
_EDITION_NAMES = [
    "doc_id",
    "n_chars",
    "edited_sha256",
    "fingerprint",
    "edited_fingerprint",
    "near_edited",
    "near_next",
    "component_id",
]


def _range_of(bounds: list[int]):
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def number(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(), side="right").astype(np.int32))

    return number


def fingerprint_editions(
    documents: DataFrame,
    groups: DataFrame | None = None,
    shingle: int = SHINGLE,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Fingerprints of documents (doc_id, text) and of their edited texts.

    A quarter of a text's characters, rounded down, makes way at its end for the first ones of the next document, by
    ascending doc_id; the first one follows the last. doc_id is a whole number; a null id comes first, rows that share
    an id are in order of their texts and stay in one range. A null text is empty. Two texts without words have a
    likeness of 1, equal texts have equal fingerprints.

    Returns for each row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next
    (likeness to the edited text and to the next document), component_id (from ``groups``, see ``near_duplicates``; the
    own id where it names none).
    """
    spark = documents.sparkSession
    id_field = documents.schema["doc_id"]
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST_KEY)).alias("key")
    rows = documents.select("doc_id", key, F.coalesce("text", F.lit("")).alias("text"))
    count = rows.count()
    ranges = max(1, min(MOST_RANGES, count // range_rows))
    bounds: list[int] = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        found = rows.agg(F.percentile_approx("key", shares, 4 * ranges)).first()[0]
        bounds = sorted(set(found))
    number = _range_of(bounds)
    rows = rows.withColumn("range", number("key"))
    # the first document of each range goes to the range before it, too; that of the first one to the last
    firsts = sorted(tuple(r) for r in rows.groupBy("range").agg(F.min("key")).collect())
    targets = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    heads = spark.createDataFrame(targets, "key long, range int")
    # two numbers for each range, MOST_RANGES of them at most
    following = (
        rows.drop("range").join(F.broadcast(heads), "key").groupBy("range", "key").agg(F.min("text").alias("text"))
    )
    none_id = F.lit(None).cast(id_field.dataType)
    parts = rows.select(
        "range", F.lit(0).alias("last"), "key", F.lit(_DOCUMENT).alias("kind"), "doc_id", "text", none_id.alias("component")
    ).union(
        following.select("range", F.lit(1), "key", F.lit(_NEXT_RANGE), none_id, "text", none_id)
    )
    if groups is not None:
        label_key = F.col("doc_id").cast("long").alias("key")
        labels = groups.select("doc_id", label_key, "component_id").withColumn("range", number("key"))
        parts = parts.union(
            labels.select("range", F.lit(0), "key", F.lit(_LABEL), "doc_id", F.lit(""), "component_id")
        )
    schema = T.StructType(
        [
            id_field,
            *T.StructType.fromDDL(
                "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
                " near_edited double, near_next double"
            ).fields,
            T.StructField("component_id", id_field.dataType),
        ]
    )
    # as many partitions as ranges: what a task sorts and holds does not depend on the shuffle's own number of partitions
    return (
        parts.repartition(min(ranges, MOST_PARTITIONS), "range")
        .sortWithinPartitions("range", "last", "key", "kind", "text")
        .select("kind", "doc_id", "text", "component")
        .mapInArrow(_editions(shingle, to_arrow_type(id_field.dataType)), schema)
    )
