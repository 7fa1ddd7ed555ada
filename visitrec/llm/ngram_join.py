"""Near-duplicate documents: an n-gram Jaccard join by vertical partitioning.

1. Every text becomes its set of distinct n-grams (hashes of n words). Documents with equal sets form a class.
2. The n-grams get a global order, rare ones first; frequencies are those of ``2 ** SLOT_BITS`` hash slots.
   Of a set only a prefix in this order is dealt out: two sets that are similar enough share an n-gram there.
   N-grams that more than ``CROWD`` sets then turn out to share go to the end of the order, and the sets are dealt
   again, ``DEALS`` times at most; which n-grams they are is kept in a bitmap of fixed size. Any order is right, this
   one keeps passages that many texts hold from making large buckets of texts that have little else in common.
   In each bucket of the prefix join, the set with the earliest position is compared with the others.
3. The order is cut into fragments. For the pairs that are left, the overlap in each fragment is counted on
   its own and summed for each pair. Pairs over the threshold are links.
4. Links make components. Where a bucket then still holds several components, all pairs between them that
   the size and position bounds allow are compared likewise, so no link between components is missed.

A bucket is never gathered: its first set comes from a partial aggregation, and the join with it is one that
Spark splits where a key is hot. Copies are dropped before dealing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.llm import arrays as A
from visitrec.llm.bitmap import bitmap_of, may_be_in, may_hold
from visitrec.llm.components import components
from visitrec.storage import Scratch

NGRAM, THRESHOLD, FRAGMENTS = 5, (80, 100), 4
SLOT_BITS = 18
#: Least bits of a set's parity map: bit i tells whether an odd number of its n-grams fall on i.
PARITY_BITS = 256
#: An n-gram in the prefixes of more sets goes to the end of the order; how often sets are dealt at most.
CROWD, DEALS = 4, 3
#: A slot's count is reported by a task if it is so many times the task's mean.
NOTABLE = 4
#: Bits of the map of repeated ids: so many for each id, within these powers of two (8 MB at most).
ID_BITS, LEAST_BITS, MOST_BITS = 16, 16, 26


@dataclass(frozen=True)
class Similarity:
    """Intersection over union of at least ``num / den``, in whole numbers."""

    num: int
    den: int

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """How many n-grams of a set of n must be dealt out."""
        return n - (self.num * n + self.den - 1) // self.den + 1

    def reached(self, overlap: Column, total: Column) -> Column:
        return (self.num + self.den) * overlap >= self.num * total

    def possible(self, n: Column, at: Column, other_n: Column, other_at: Column) -> Column:
        """By the sizes, and by what can be shared from the common n-gram on."""
        most = F.least(n - at, other_n - other_at)
        return (self.den * F.least(n, other_n) >= self.num * F.greatest(n, other_n)) & self.reached(
            most, n + other_n
        )


def _sets(block: A.Block, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; the whole sequence where it has fewer words."""
    words = A.words_of(block)
    hashes = A.span_hashes(A.folded(block.data), words.starts, words.ends)
    runs = A.run_hashes(hashes, n)
    out = []
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        own = runs[a : b - n + 1] if b - a >= n else A.run_hashes(hashes[a:b], b - a) if b > a else runs[:0]
        own = np.sort(own)
        out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return out


def _signature(grams: np.ndarray) -> tuple[int, int]:
    one = int(A.mix(grams).sum(dtype=np.uint64))
    two = int(A.mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return one, two


def _parity(grams: np.ndarray) -> np.ndarray:
    """A map of 2 to 4 bits for each n-gram. Two maps differ in no more bits than the sets in n-grams.

    The two halves of a map combined are the map of half as many bits.
    """
    bits = PARITY_BITS
    while bits < 2 * len(grams):
        bits *= 2
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _summaries(n: int):
    """A row for each text (slot is -1), then one for each notable slot of the task."""

    def rows(ids, sizes, one, two, parity, slots, weights) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), A.signed(one), A.signed(two)]
            + [pa.array(parity, pa.list_(pa.int64()))]
            + [pa.array(slots, pa.int32()), pa.array(weights, pa.int64())],
            names=["doc_id", "n", "one", "two", "parity", "slot", "weight"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(1 << SLOT_BITS, dtype=np.int64), None
        for batch in batches:
            kind = batch.column("doc_id").type
            for block in A.blocks(batch.column("text")):
                sets = _sets(block, n)
                pairs = np.array([_signature(s) for s in sets], dtype=np.uint64).reshape(-1, 2)
                counts += np.bincount(_slot(np.concatenate(sets)), minlength=1 << SLOT_BITS)
                yield rows(
                    batch.column("doc_id").slice(block.first, len(block)),
                    [len(s) for s in sets],
                    np.ascontiguousarray(pairs[:, 0]),
                    np.ascontiguousarray(pairs[:, 1]),
                    [_parity(s) for s in sets],
                    np.full(len(sets), -1),
                    np.zeros(len(sets), dtype=np.int64),
                )
        if kind is not None:
            slots = np.flatnonzero(counts > max(8, NOTABLE * counts.mean()))
            zeros = np.zeros(len(slots), dtype=np.uint64)
            yield rows(
                pa.nulls(len(slots), kind), zeros, zeros, zeros, [None] * len(slots), slots, counts[slots]
            )

    return scan


def _prefixes(n: int, similar: Similarity, weights, crowded=None):
    """The prefix n-grams of each set, with their position; once for each set in a task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = weights.value, set()
        for batch in batches:
            for block in A.blocks(batch.column("text")):
                tokens, owners, places, sizes = [], [], [], []
                for k, grams in enumerate(_sets(block, n)):
                    if not len(grams) or (signature := _signature(grams)) in seen:
                        continue
                    seen.add(signature)
                    rank = table[_slot(grams)]
                    if crowded is not None:
                        rank = rank + (may_hold(crowded.value, grams).astype(np.int64) << 48)
                    order = np.argsort(rank, kind="stable")
                    first = grams[order[: int(similar.prefix(len(grams)))]]
                    tokens.append(first)
                    places.append(np.arange(len(first), dtype=np.int32))
                    owners.append(np.full(len(first), block.first + k))
                    sizes.append(np.full(len(first), len(grams), dtype=np.int32))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [
                            A.signed(np.concatenate(tokens)),
                            batch.column("doc_id").take(pa.array(np.concatenate(owners))),
                            pa.array(np.concatenate(places)),
                            pa.array(np.concatenate(sizes)),
                        ],
                        names=["gram", "doc_id", "at", "n"],
                    )
            A.give_back()

    return scan


def _fragments(n: int, fragments: int, wanted):
    """The sets of the wanted documents, cut at fixed places of the hash range."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(i << 64) // fragments for i in range(1, fragments)], dtype=np.uint64)
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(may_hold(wanted.value, keys)))
            for block in A.blocks(batch.column("text")):
                parts, owners, numbers = [], [], []
                for k, grams in enumerate(_sets(block, n)):
                    for number, part in enumerate(np.split(grams, np.searchsorted(grams, edges))):
                        if len(part):
                            parts.append(part)
                            owners.append(block.first + k)
                            numbers.append(number)
                if parts:
                    bounds = np.cumsum([0, *map(len, parts)])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array(owners)),
                            pa.array(numbers, pa.int32()),
                            pa.ListArray.from_arrays(
                                pa.array(bounds, pa.int32()), A.signed(np.concatenate(parts))
                            ),
                        ],
                        names=["doc_id", "fragment", "grams"],
                    )
            A.give_back()

    return scan


class _Join:
    def __init__(self, documents: DataFrame, ngram: int, similar: Similarity, fragments: int) -> None:
        self.spark = documents.sparkSession
        self.scratch = Scratch(self.spark, "ngrams")
        self.rows = documents.select("doc_id", "text")
        self.id = documents.schema["doc_id"]
        self.ngram, self.similar, self.fragments = ngram, similar, fragments

    def _schema(self, ddl: str) -> T.StructType:
        return T.StructType([self.id, *T.StructType.fromDDL(ddl).fields])

    def run(self) -> DataFrame:
        scanned = self.scratch.keep(
            self.rows.mapInArrow(
                _summaries(self.ngram),
                self._schema("n long, one long, two long, parity array<long>, slot int, weight long"),
            ),
            "summaries",
        )
        texts = scanned.filter("slot < 0").select("doc_id", "n", "one", "two")
        classes = self.scratch.keep(
            texts.filter("n > 0 AND doc_id IS NOT NULL").groupBy("one", "two").agg(F.min("doc_id").alias("class")), "classes"
        )
        classed = self.scratch.keep(
            texts.join(classes, ["one", "two"], "left").select(
                "doc_id",
                "n",
                F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("class")).alias("class"),
            ),
            "classed",
        )
        labels = self._labels(scanned, classed)
        return classed.join(labels.withColumnRenamed("node", "class"), "class", "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id")).alias(
                "component_id"
            ),
        )

    def _labels(self, scanned: DataFrame, classed: DataFrame) -> DataFrame:
        weights = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        sums = scanned.filter("slot >= 0").groupBy("slot").agg(F.sum("weight").alias("weight")).toPandas()
        weights[sums["slot"].to_numpy(dtype=np.int64)] = sums["weight"].to_numpy(dtype=np.int64)
        dealt, shared = self._dealt(self.spark.sparkContext.broadcast(weights))
        met = self.scratch.keep(dealt.join(shared, "gram"), "met")
        self.scratch.drop("prefixes")
        firsts = self.scratch.keep(
            met.groupBy("gram").agg(
                F.min("at").alias("first_at"),
                F.min_by("doc_id", _order()).alias("first"),
                F.min_by("n", _order()).alias("first_n"),
            ),
            "firsts",
        )
        class_of = classed.filter("class IS NOT NULL").select("doc_id", "class").distinct()
        stars = met.join(firsts, "gram").filter(F.col("doc_id") != F.col("first")).filter(
            self.similar.possible(F.col("n"), F.col("at"), F.col("first_n"), F.col("first_at"))
        )
        tried = self.scratch.keep(
            self._by_class(stars.select(F.col("first").alias("a"), F.col("doc_id").alias("b")), class_of),
            "tried",
        )
        links = self._links(self._plausible(tried, scanned), classed, "links")
        labels = components(links, self.scratch)
        rest = self._plausible(self._between(met, class_of, labels, tried), scanned)
        rest = self.scratch.keep(rest, "rest")
        if not rest.isEmpty():
            more = self._links(rest, classed, "more-links")
            if not more.isEmpty():
                labels = components(links.union(more), self.scratch, "all")
        self.scratch.drop("met")
        return labels

    def _dealt(self, order: Broadcast) -> tuple[DataFrame, DataFrame]:
        """Prefixes, and the n-grams that several of them hold; crowded ones go to the end of the order."""
        schema = T.StructType.fromDDL(f"gram long, doc_id {self.id.dataType.simpleString()}, at int, n int")
        rows, crowded = self.rows.filter("doc_id IS NOT NULL"), None
        for deal in range(1, DEALS + 1):
            prefixes = _prefixes(self.ngram, self.similar, order, crowded)
            dealt = self.scratch.keep(rows.mapInArrow(prefixes, schema), "prefixes")
            members = dealt.groupBy("gram").agg(F.count(F.lit(1)).alias("members"))
            shared = self.scratch.keep(members.filter("members > 1"), "shared")
            if deal == DEALS:
                break
            found = bitmap_of(shared.filter(F.col("members") > CROWD), F.col("gram"))
            known = np.zeros_like(found.value) if crowded is None else crowded.value
            if not (found.value & ~known).any():
                break
            crowded = self.spark.sparkContext.broadcast(found.value | known)
            self.scratch.drop("prefixes")
            self.scratch.drop("shared")
        return dealt, shared

    @staticmethod
    def _by_class(pairs: DataFrame, class_of: DataFrame) -> DataFrame:
        """Distinct pairs of classes, the smaller first."""
        for side in ("a", "b"):
            named = class_of.select(F.col("doc_id").alias(side), F.col("class").alias(f"{side}_class"))
            pairs = pairs.distinct().join(named, side) if side == "a" else pairs.join(named, side)
        pairs = pairs.select(F.col("a_class").alias("a"), F.col("b_class").alias("b")).filter("a <> b")
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _plausible(self, pairs: DataFrame, scanned: DataFrame) -> DataFrame:
        """Pairs whose parity maps allow the overlap."""
        for side in ("a", "b"):
            own = scanned.filter("n > 0 AND doc_id IS NOT NULL").select(
                F.col("doc_id").alias(side), F.col("n").alias(f"{side}_n"), F.col("parity").alias(f"{side}_map")
            )
            pairs = pairs.join(own, side)
        size = F.least(F.size("a_map"), F.size("b_map"))

        def folded(side: str) -> Column:
            halves = F.slice(side, F.lit(1), size), F.slice(side, size + 1, size)
            both = F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))
            return F.when(F.size(side) == 2 * size, both).otherwise(F.col(side))

        differ = F.aggregate(
            F.zip_with(folded("a_map"), folded("b_map"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
            F.lit(0),
            lambda total, bits: total + bits,
        )
        total = F.col("a_n") + F.col("b_n")
        close = F.greatest(F.size("a_map"), F.size("b_map")) <= 2 * size  # else sizes differ too much to tell
        reached = self.similar.reached((total - differ) / 2, total)
        return pairs.filter(~close | reached).select("a", "b")

    def _links(self, pairs: DataFrame, classed: DataFrame, label: str) -> DataFrame:
        """Which pairs reach the threshold: overlaps by fragment, summed for each pair."""
        nodes = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        wanted = bitmap_of(nodes, F.xxhash64("doc_id"))
        parts = self.scratch.keep(
            self.rows.filter("doc_id IS NOT NULL")
            .withColumn("key", F.xxhash64("doc_id"))
            .mapInArrow(
                _fragments(self.ngram, self.fragments, wanted),
                self._schema("fragment int, grams array<long>"),
            ),
            f"{label}-fragments",
        )
        sizes = classed.filter("doc_id = class").select("doc_id", "n").distinct()
        left = parts.select(F.col("doc_id").alias("b"), "fragment", F.col("grams").alias("b_grams"))
        right = parts.select(F.col("doc_id").alias("a"), "fragment", F.col("grams").alias("a_grams"))
        overlap = F.size(F.array_intersect("a_grams", "b_grams"))
        sums = (
            pairs.join(left, "b")
            .join(right, ["a", "fragment"])
            .select("a", "b", overlap.alias("overlap"))
            .groupBy("a", "b")
            .agg(F.sum("overlap").alias("overlap"))
        )
        for side in ("a", "b"):
            sums = sums.join(sizes.select(F.col("doc_id").alias(side), F.col("n").alias(f"{side}_n")), side)
        links = sums.filter(self.similar.reached(F.col("overlap"), F.col("a_n") + F.col("b_n")))
        links = self.scratch.keep(links.select("a", "b"), label)
        self.scratch.drop(f"{label}-fragments")
        return links

    def _between(
        self, met: DataFrame, class_of: DataFrame, labels: DataFrame, tried: DataFrame
    ) -> DataFrame:
        """Pairs in a bucket that lie in different components and weren't compared."""
        rows = (
            met.filter("members > 2")
            .select("gram", "doc_id", "at", "n")
            .join(class_of, "doc_id")
            .join(labels.withColumnRenamed("node", "class"), "class", "left")
            .select("gram", "class", "at", "n", F.coalesce("component", "class").alias("label"))
        )
        rows = self.scratch.keep(rows, "labelled")
        mixed = self.scratch.keep(
            rows.groupBy("gram")
            .agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .filter("low < high")
            .select("gram"),
            "mixed",
        )
        rows = self.scratch.keep(rows.join(mixed, "gram").distinct(), "mixed-rows")
        self.scratch.drop("labelled")
        one = rows.select("gram", *(F.col(c).alias(f"a_{c}") for c in ("class", "at", "n", "label")))
        two = rows.select("gram", *(F.col(c).alias(f"b_{c}") for c in ("class", "at", "n", "label")))
        pairs = (
            one.join(two, "gram")
            .filter("a_label < b_label")
            .filter(self.similar.possible(*(F.col(c) for c in ("a_n", "a_at", "b_n", "b_at"))))
            .select(F.col("a_class").alias("a"), F.col("b_class").alias("b"))
        )
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return pairs.join(tried, ["a", "b"], "left_anti")


def _order() -> Column:
    """Rank in a bucket: by position, then by a hash of the document, in one long."""
    spread = F.shiftrightunsigned(F.xxhash64("doc_id"), 32)
    return F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(spread)


def near_duplicates(
    documents: DataFrame,
    ngram: int = NGRAM,
    threshold: tuple[int, int] = THRESHOLD,
    fragments: int = FRAGMENTS,
) -> DataFrame:
    """Groups of documents (doc_id, text) linked by Jaccard similarity of their word n-grams.

    Words are runs of anything but ASCII white space, with A-Z lower-cased. ``threshold`` is a fraction:
    sets link if ``den * intersection >= num * union``. A text with fewer than ``ngram`` words is one
    n-gram; a null or empty text has none and links with nothing.

    Returns a row for each row of ``documents``: doc_id, n_shingles, component_id (the smallest doc_id that
    links reach, its own included). Rows that share a doc_id share the smallest component of any of them.
    A row without an id is linked with nothing and has no component.
    """
    similar = Similarity(*threshold)
    ids = documents.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    if ids.filter("rows > 1").isEmpty():
        return _Join(documents, ngram, similar, fragments).run()
    # rows that share an id: number the different rows, join those, and go back to ids
    numbered = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("number"))
    once = numbered.dropDuplicates(["number"]).select(F.col("number").alias("doc_id"), "text")
    groups = _Join(once, ngram, similar, fragments).run().withColumnRenamed("doc_id", "number")
    groups = Scratch(documents.sparkSession, "ngrams").keep(
        numbered.select("doc_id", "number").join(groups, "number"), "numbered"
    )
    lowest = groups.groupBy("component_id").agg(F.min("doc_id").alias("lowest"))
    named = groups.join(lowest, "component_id")
    own = named.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("lowest").alias("own"))
    return named.join(own, "doc_id", "left").select("doc_id", "n_shingles", F.col("own").alias("component_id"))


def deduplicated(documents: DataFrame, **options) -> DataFrame:
    """One row of each group of near-duplicates, with all columns: that with the smallest doc_id.

    Of rows that share a doc_id one stays. Rows without an id are not judged and stay.

    Rows whose id is on no list stay where they are: a map of the listed ids tells, and only rows that it may hold
    are shuffled for the exact joins. With more than ``2 ** MOST_BITS / ID_BITS`` ids it lets more rows through.
    """
    groups = near_duplicates(documents, **options).filter("doc_id IS NOT NULL")
    counted = groups.groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("rows")
    )
    spark = documents.sparkSession
    counted = Scratch(spark, "dedup").keep(counted, "groups")
    gone = counted.filter("component_id < doc_id").select("doc_id")
    repeated = counted.filter("rows > 1").select("doc_id")
    listed = counted.filter("component_id < doc_id OR rows > 1")
    bits = min(max((ID_BITS * listed.count()).bit_length(), LEAST_BITS), MOST_BITS)
    doubtful = may_be_in(bitmap_of(listed, F.xxhash64("doc_id"), bits), F.xxhash64("doc_id"))
    unlisted = documents.filter(~doubtful)
    kept = documents.filter(doubtful).join(gone, "doc_id", "left_anti").select(*_quoted(documents))
    if repeated.isEmpty():
        return unlisted.union(kept)
    once = kept.join(repeated, "doc_id", "left_anti").select(*_quoted(documents))
    again = kept.join(repeated, "doc_id", "left_semi").select(*_quoted(documents))
    return unlisted.union(once).union(again.dropDuplicates(["doc_id"]))


def _quoted(df: DataFrame) -> list[Column]:
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]
