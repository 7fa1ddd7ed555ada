"""Fingerprints, editions and near-duplicates against plain versions, odd rows included."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from visitrec.llm import arrays as A
from visitrec.llm.minhash import HELD_BYTES, PERMUTATIONS, _editions, _fingerprints
from visitrec.llm.minhash import fingerprint_editions, likeness, near_duplicates
from visitrec.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, `text.x` string, key int, kind string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3, "k") for i, t in rows], SCHEMA).repartition(3)


def shingles(text, n=5):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", lower)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def jaccard(one, two):
    a, b = shingles(one), shingles(two)
    return len(a & b) / len(a | b) if a | b else 1.0


def editions(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for (number, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        yield number, text, text[: len(text) - cut] + following[:cut], following


def check(spark, rows, **options):
    got = sorted(
        fingerprint_editions(frame(spark, rows), **options).collect(),
        key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256),
    )
    want = [
        (i, len(t), hashlib.sha256(e.encode()).hexdigest(), t, e, f) for i, t, e, f in editions(rows)
    ]
    want.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert [tuple(r)[:3] for r in got] == [r[:3] for r in want]
    prints = {}
    for row, (_, _, _, text, edited, following) in zip(got, want):
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        assert prints.setdefault(edited, row.edited_fingerprint) == row.edited_fingerprint
    for row, (_, _, _, text, edited, following) in zip(got, want):
        assert row.near_edited == likeness(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == likeness(row.fingerprint, prints[following])
        # five standard deviations of an estimate from so many places
        assert abs(row.near_edited - jaccard(text, edited)) < 2.5 / PERMUTATIONS**0.5
        assert abs(row.near_next - jaccard(text, following)) < 2.5 / PERMUTATIONS**0.5
    return got


def invented(seed, n):
    pick = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(400)]
    rows = []
    for i in range(n):
        if rows and pick.random() < 0.4:
            words = rows[pick.randrange(len(rows))][1].split()
            for _ in range(pick.choice([0, 1, 2, 6])):
                if words:
                    words[pick.randrange(len(words))] = pick.choice(vocabulary)
        else:
            words = pick.choices(vocabulary, k=pick.choice([0, 1, 3, 5, 40, 200]))
        rows.append((i * 3, pick.choice([" ", "\n"]).join(words)))
    return rows


ODD = [
    (None, None),
    (None, "no id here at all, none"),
    (1, ""),
    (2, " \n\t "),
    (3, "one"),
    (5, "ONE"),
    (5, "one two three four five six seven"),
    (5, "one two three four five six seven"),
    (6, "word " * 60_000),
    (7, "x" * 100_000),
    (-4, "é" * 301 + " 漢字 \U0001f600" * 9),
]


@pytest.mark.parametrize("range_rows", [2000, 10, 1])
def test_editions(spark, range_rows):
    check(spark, invented(1, 120), range_rows=range_rows)


@pytest.mark.parametrize("range_rows", [2000, 2])
def test_odd_rows(spark, range_rows):
    check(spark, ODD, range_rows=range_rows)


def test_one_row_follows_itself(spark):
    (row,) = check(spark, [(9, "a b c d e f g h i j")])
    assert row.near_next == 1.0 and row.component_id == 9


def test_empty(spark):
    assert fingerprint_editions(frame(spark, [])).collect() == []
    assert near_duplicates(frame(spark, [])).collect() == []
    assert fingerprint_editions(frame(spark, [])).columns[0] == "doc_id"


def components_of(rows, num=80, den=100):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((root(a), root(b)))
                    label[high] = low
    return {i: root(i) for i in sets if root(i) < i}


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_components(spark, seed):
    rows = invented(seed, 300)
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == components_of(rows) and got


def test_a_large_group_of_near_copies(spark):
    base = [f"c{i}" for i in range(100)]
    rows = []
    for i in range(400):
        words = list(base)
        words[i % 97] = f"own{i}"
        rows.append((i + 10, " ".join(words)))
    rows += [(1000 + i, f"alone {i} " + " ".join(f"u{i}x{j}" for j in range(30))) for i in range(50)]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: 10 for i in range(11, 410)}


def test_two_that_link_among_many_that_do_not(spark):
    pick, rows = random.Random(8), []
    for family in range(3):
        base = [f"f{family}w{i}" for i in range(300)]
        # six changes leave hardly any similarity of 0.8 to each other, the last two have three
        for i in range(202):
            words = list(base)
            for at in pick.sample(range(5, 295, 6), 6) if i < 200 else range(7 + i % 2 * 80, 55 + i % 2 * 80, 16):
                words[at] = f"f{family}own{i}x{at}"
            rows.append((family * 1000 + i, " ".join(words)))
    expected = components_of(rows)
    assert [expected.get(i) for i in (201, 1201, 2201)] == [200, 1200, 2200]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == expected


def test_odd_rows_have_groups(spark):
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, ODD)).collect()}
    assert got == {5: 3}


def test_query(spark):
    rows = QUERIES["op12_minhash"](spark, SF).collect()
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = {i: hashlib.sha256(e.encode()).hexdigest() for i, _, e, _ in editions(documents)}
    assert {r.doc_id: r.edited_sha256 for r in rows} == expected
    groups = components_of(documents)
    assert {r.doc_id: r.component_id for r in rows} == {i: groups.get(i, i) for i, _ in documents}


def morse(n):
    out = "a"
    while len(out) < n:
        out += out.translate(str.maketrans("ab", "ba"))
    return out


@pytest.mark.parametrize("size", [64, 512, 1024, 4096])
def test_span_hashes_tell_regular_words_apart(size):
    one = morse(size)
    words = [one, one.translate(str.maketrans("ab", "ba")), one[::-1], "a" * size, "b" * size, one[:-1], one + "a"]
    (block,) = A.blocks(pa.array([" ".join(words)]))
    found = A.words_of(block)
    assert len(set(A.span_hashes(block.data, found.starts, found.ends).tolist())) == len(set(words))


def test_span_hashes_depend_on_the_bytes_alone():
    pick = np.random.default_rng(1)
    data = pick.integers(0, 4, 3000).astype(np.uint8)
    starts = pick.integers(0, 2300, 4000)
    ends = starts + pick.integers(0, 700, 4000)
    by_bytes = {}
    for s, e, h in zip(starts.tolist(), ends.tolist(), A.span_hashes(data, starts, ends).tolist()):
        assert by_bytes.setdefault(data[s:e].tobytes(), h) == h
    assert len(set(by_bytes.values())) == len(by_bytes)
    assert A.span_hashes(data, starts, ends, 1).tolist() != A.span_hashes(data, starts, ends).tolist()


def test_ranges_are_dealt_to_as_many_partitions(spark):
    """Eight partitions, the session's number, would hold 40 ranges each on average."""
    documents = spark.createDataFrame([(i, f"text {i}") for i in range(1280)], "doc_id long, text string")
    out = fingerprint_editions(documents, range_rows=4)
    sizes = out.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.sum() == 1280 and sizes.max() <= 60


def test_editions_hold_a_block_of_a_batch():
    """The texts of a batch become strings a block at a time."""
    n, text = 2000, "word " * 2000
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1] * n, pa.int32()), pa.array(range(n)), pa.array([text] * n), pa.nulls(n, pa.int64())],
        names=["kind", "doc_id", "text", "component"],
    )
    tracemalloc.start()
    rows = next(_editions(5, pa.int64())(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < len(rows) < n
    assert peak < 15 * (1 << 20) + _flush_peak(text)


def _flush_peak(text):
    """What the fingerprints of a block take by themselves."""
    tracemalloc.start()
    _fingerprints([text] * (HELD_BYTES // len(text) + 2), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak
