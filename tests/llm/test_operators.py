"""Each operator against a plain version on small tables, odd rows included."""

import base64
import datetime as dt
import hashlib
import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from visitrec.llm import suffix_arrays, unigram
from visitrec.llm.chat import preference_pairs
from visitrec.llm.kd_shards import shard_documents
from visitrec.llm.ngram_join import deduplicated, near_duplicates
from visitrec.llm.outliers import quality_rules
from visitrec.llm.pii import base_spans, find_pii, fit_crf, labelled_table, luhn, redacted
from visitrec.llm.suffix_dedup import remove_repeats
from visitrec.llm.toxicity import fit_severity, severity, without_toxic
from visitrec.llm.warc import compressed, frames, parsed, read_archives, write_archives
from visitrec.llm.winnow import benchmark_hits, decontaminated

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_words string, `a.b` int"

LONG = " ".join(f"word{i}" for i in range(3000))
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two three"),
    (5, "One TWO three"),
    (6, LONG),
    (7, LONG + " more"),
    (8, LONG),
    (8, LONG),
    (None, LONG),
    (9, "x" * 5000),
    (10, "é" * 300 + " " + "é" * 300),
    (11, "same line here now\nsame line here now\nsame line here now"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, "7", 1) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def plain_components(rows, n, num, den):
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i, _ in sets}


def test_near_duplicates(spark, odd, empty):
    groups = near_duplicates(odd).collect()
    assert len(groups) == len(ODD)
    expected = plain_components(ODD, 5, 80, 100)
    assert {r.doc_id: r.component_id for r in groups if r.doc_id is not None} == expected
    assert [r.component_id for r in groups if r.doc_id is None] == [None]
    kept = deduplicated(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 2, 3, 4, 6, 9, 10, 11] and ids.count(None) == 1
    assert near_duplicates(empty).count() == 0 and deduplicated(empty).count() == 0


def test_chain_of_near_duplicates(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(100 - k, " ".join(words[: 60 - k] + [f"x{i}" for i in range(k)])) for k in range(12)]
    rows += [(200 + k, " ".join(words[k:] + words[:k])) for k in range(4)]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == plain_components(rows, 5, 80, 100)


def plain_hits(text, items):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    words, hit, found = find(lower(text)), set(), set()
    for i, t in items:
        own = find(lower(t))
        n = min(10, len(own))
        windows = {tuple(own[a : a + n]) for a in range(len(own) - n + 1)} if n else set()
        for a in range(len(words) - n + 1):
            if n and tuple(words[a : a + n]) in windows:
                hit.update(range(a, a + n))
                found.add(i)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)


def test_winnowing(spark, odd, empty):
    items = [
        (1, "word100 word101 word102 word103 word104 word105 word106 word107 word108 word109 word110 q"),
        (2, "Two-THREE"),
        (3, None),
        (4, "..."),
        (10, " ".join(f"word{i}" for i in range(2990, 3000)) + " more"),
        (None, "same line here now same"),
        (2, "two three"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(
        ((r.doc_id or 0, r.n_words, r.n_hit, r["items"]) for r in benchmark_hits(odd, benchmark).collect()),
        key=str,
    )
    expected = sorted(((i or 0, *plain_hits(t, items)) for i, t in ODD), key=str)
    assert got == expected
    hit = {i for i, t in ODD if plain_hits(t, items)[1]}
    kept = decontaminated(odd, benchmark)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in ODD if i not in hit)
    none = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_hits(odd, none).filter("contaminated").isEmpty()
    assert benchmark_hits(empty, benchmark).isEmpty()


def plain_removed(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, b in texts:
        for a in range(len(b) - length + 1):
            seen[b[a : a + length]] = seen.get(b[a : a + length], 0) + 1
    out = []
    for i, b in texts:
        gone = set()
        for a in range(len(b) - length + 1):
            if seen[b[a : a + length]] > 1:
                gone.update(range(a, a + length))
        kept = bytes(c for k, c in enumerate(b) if k not in gone)
        spans = sum(1 for k in gone if k - 1 not in gone)
        out.append((i or 0, len(b), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [20_000, 0])
def test_repeats(spark, odd, empty, hot, monkeypatch):
    monkeypatch.setattr("visitrec.llm.suffix_dedup.HOT", hot)
    passage = " ".join(f"shared{i}" for i in range(40))
    rows = ODD + [(20 + k, f"{'lead' * k} {passage[k * 7:]} tail{k} " * (1 + k % 2)) for k in range(6)]
    for length, gram in ((200, 50), (60, 20)):
        got = remove_repeats(frame(spark, rows), length, gram).drop("kept").collect()
        assert sorted((r.doc_id or 0, *r[1:]) for r in got) == plain_removed(rows, length)
    assert remove_repeats(empty).isEmpty()


@pytest.mark.parametrize("most,few", [(512, 12), (512, 0), (0, 12)])
def test_suffix_order(most, few, monkeypatch):
    monkeypatch.setattr(suffix_arrays, "MOST_SYMBOLS", most)
    monkeypatch.setattr(suffix_arrays, "FEW", few)
    rng = np.random.default_rng(3)
    for _ in range(200):
        symbols = int(rng.integers(2, 7))
        text = [*rng.integers(1, symbols, rng.integers(0, 80)).tolist(), 0]
        order = suffix_arrays.suffix_array(np.array(text), symbols)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_order_recurses(monkeypatch):
    """Many different substrings: the string of their names has more symbols than are sorted in bulk."""
    text = np.append(np.random.default_rng(5).integers(1, 20, 30_000), 0)
    text[10_000:20_000] = text[:10_000]
    called = []
    singly = suffix_arrays._induce_singly
    monkeypatch.setattr(suffix_arrays, "_induce_singly", lambda *a: called.append(a[3]) or singly(*a))
    order = suffix_arrays.suffix_array(text, 20)
    data = text.astype(np.uint8).tobytes()
    assert called and min(called) > suffix_arrays.MOST_SYMBOLS
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i : i + 12_000])


def test_suffix_arrays():
    strings = [b"banana", b"", b"bananas", b"aaaaaaa", b"mississippi"]
    for length in (1, 3, 5):
        counts = {}
        for s in strings:
            for a in range(len(s) - length + 1):
                counts[s[a : a + length]] = counts.get(s[a : a + length], 0) + 1
        for s, found in zip(strings, suffix_arrays.repeated_starts(strings, length)):
            assert found.tolist() == [
                a for a in range(len(s) - length + 1) if counts[s[a : a + length]] > 1
            ]


def test_quality_rules(spark, odd, empty):
    got = {r.doc_id: r for r in quality_rules(odd).collect()}
    assert got[1].n_words == got[2].n_words == 0 and got[1].base_failed and not got[1].kept
    assert (got[11].n_words, got[11].n_dup_lines) == (12, 2)
    assert got[10].word_chars == 600
    assert got[6].kept and quality_rules(empty).isEmpty()
    clean = spark.read.parquet(f"{SF}/documents.parquet").join(
        spark.read.parquet(f"{SF}/labels.parquet"), "doc_id"
    )
    kept = quality_rules(clean).filter("NOT base_failed").join(clean.select("doc_id", "quality"), "doc_id")
    share = {r.quality: r.share for r in kept.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.99 and share.get(0, 0) < share[1]


def test_toxicity(spark, odd, empty):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = fit_severity(documents, labels.filter("doc_id % 2 = 0"))
    truth = labels.filter("doc_id % 2 = 1").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    held = severity(documents, model).join(truth, "doc_id").groupBy("label", "toxic").count().collect()
    found = {(r.label, r.toxic): r["count"] for r in held}
    assert found[(1, True)] > 9 * found.get((1, False), 0)
    assert found[(0, False)] > 20 * found.get((0, True), 0)
    assert severity(odd, model).count() == len(ODD) and severity(empty, model).isEmpty()
    assert without_toxic(odd, model).columns == odd.columns
    assert fit_severity(empty, labels).weights.size == 0


def test_pii(spark, odd, empty):
    text = "Mail é a.b@c.example.com, call +1 (724) 555-7058 or 10.0.0.300 10.0.0.30; card 4111 1111 1111 1111."
    spans = [(text[a:b], k) for a, b, k in base_spans(text)]
    assert spans == [
        ("a.b@c.example.com", 0),
        ("+1 (724) 555-7058", 3),
        ("10.0.0.30", 1),
        ("4111 1111 1111 1111", 2),
    ]
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    model = fit_crf(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = frame(spark, [*ODD, (50, text)])
    got = {r.doc_id: r for r in find_pii(rows, model).collect()}
    assert len(got[50].base) == 4 and got[1].spans == []
    clean = {r.doc_id: r.text for r in redacted(rows, model).collect()}
    assert clean[1] is None and clean[6] == LONG
    assert clean[50].startswith("Mail é <email>, call <phone> or ")
    assert find_pii(empty, model).isEmpty() and find_pii(empty, fit_crf(empty)).isEmpty()


def test_labelled_table_does_not_depend_on_partitions(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("text").distinct()
    tables = [labelled_table(texts.repartition(n), 40) for n in (1, 7)]
    first, second = (sorted((tuple(r.features), tuple(r.labels)) for r in t.collect()) for t in tables)
    assert first == second and len(first) == 40
    assert sum(any(labels) for _, labels in first) == 20
    assert labelled_table(texts, 0).isEmpty()


def test_shards(spark, odd, empty):
    got = shard_documents(odd, 4).collect()
    assert len(got) == len(ODD) and {r.law for r in got} == {"bytes"}
    rows = [(i, "t" * (50 + i % 7)) for i in range(2000)]
    dealt = shard_documents(frame(spark, rows), 40).toPandas()
    sizes = dealt.groupby("shard")["size"].sum()
    assert len(sizes) == 40 and sizes.max() - sizes.min() < 0.1 * sizes.mean()
    assert all(sorted(own) == list(range(len(own))) for _, own in dealt.groupby("shard")["slot"])
    assert shard_documents(empty).isEmpty()


def test_preference_pairs(spark):
    schema = "pair_id long, turn int, role string, text string, prompt int"
    shared = [(1, 0, "user", "hi <|end|>", 0), (1, 1, "assistant", None, 0)]
    chosen = [*shared, (1, 2, "user", "same", 0), (1, 3, "assistant", "good", 0), (2, 0, "user", "a", 0), (3, 0, "user", "b", 0)]
    rejected = [*shared, (1, 2, "user", "same", 0), (1, 3, "assistant", "bad one", 0), (3, 0, "user", "b", 0), (3, 1, "assistant", "c", 0), (None, 0, "user", "z", 0)]
    got = {
        r.pair_id: r
        for r in preference_pairs(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema)).collect()
    }
    assert set(got) == {1, 3} and got[1].n_prompt_turns == 3
    assert got[1].prompt.count("<|end|>") == 3
    (span,) = got[1].rejected_spans
    assert got[1].rejected[span.start : span.end] == "bad one<|end|>"
    assert got[3].chosen == "" and got[3].chosen_spans == [] and got[3].n_prompt_turns == 1
    none = spark.createDataFrame([], schema)
    assert preference_pairs(none, none).isEmpty()


def test_archives(spark, tmp_path):
    rows = [(1, "u", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "u", None), (4, "u\r\nx: y", ""), (5, "u", "é" * 9), (None, "u", "<p>same</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for least in (0, 5):
        folder = str(tmp_path / str(least))
        got = {r.page_id: r for r in read_archives(write_archives(pages, folder, least), folder).collect()}
        assert len(got) == len(rows)
        assert (got[1].record_type, got[1].refers_to, got[2].record_type) == ("revisit", 2, "response")
        assert got[None].refers_to == 2
        assert got[3].refers_to == (4 if least == 0 else None)
        for i, _, html in rows:
            data = (html or "").encode()
            assert got[i].payload_bytes == len(data)
            assert got[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
            assert got[i].payload in (None, data)
    folder = str(tmp_path / "none")
    assert read_archives(write_archives(pages.limit(0), folder), folder).isEmpty()


def test_archive_dictionary():
    many = [b"record %d " % i * 50 for i in range(200)]
    long = [bytes(range(256)) * 5000, b"x"]
    for records in (many, many[:5], many[:1], [b""], [b"", b"a"], [b"same"] * 300, long):
        archive = compressed(records)
        assert list(frames(archive)) == records
        assert int.from_bytes(archive[4:8], "little") > 0 or not any(records)
    # five records and their dictionary take less than the records alone
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in many[:5])
    assert len(compressed(many[:5])) < plain + sum(map(len, many[:5])) // 2


def test_archived_records(spark, tmp_path):
    rows = [(1, "http://a", "<p>x</p>", "n")] * 3 + [(2, "http://b", "<p>x</p>", "n"), (None, None, None, "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, archive string")
    day = dt.datetime(2024, 3, 2, 1, 2, 3, tzinfo=dt.UTC)
    names = [r.archive for r in write_archives(pages, str(tmp_path / "own"), date=day).collect()]
    data = [d for n in names for d in frames((tmp_path / "own" / n).read_bytes())]
    fields = [parsed(d)[0] for d in data]
    assert len({f["WARC-Record-ID"] for f in fields}) == len(rows)
    assert {f["WARC-Date"] for f in fields} == {"2024-03-02T01:02:03Z"}
    revisits = [f for f in fields if f["WARC-Type"] == "revisit"]
    assert [(f["X-Page-ID"], f["WARC-Refers-To-Target-URI"]) for f in revisits] == [("1", "http://b")] * 3
    for d, f in zip(data, fields):
        block = d.partition(b"\r\n\r\n")[2][:-4]
        assert len(block) == int(f["Content-Length"]) and block.startswith(b"HTTP/1.1 200 OK\r\n")


def test_pieces(spark, odd, empty):
    path = "/opt/tokenizers/piece_bpe_32k.model"
    rows = {r.doc_id: r for r in unigram.encode(odd, path).collect()}
    assert all(r.round_trip for r in rows.values()) and rows[1].ids == []
    back = unigram.decode(unigram.encode(odd, path), path).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in ODD}
    assert unigram.encode(empty, path).isEmpty()


def test_pieces_against_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    with open("/opt/tokenizers/piece_bpe_32k.model", "rb") as source:
        data = source.read()
    own = unigram.load_model(data)
    model = proto.ModelProto()
    model.ParseFromString(data)
    model.trainer_spec.model_type = 1
    for piece, score in zip(model.pieces, own.scores):
        if piece.type == 1:
            piece.score = score
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    for text in ("the quick brown fox", " two  spaces", "naïve café", "日本語 テキスト", "a", "word " * 9):
        block = next(iter(unigram.A.blocks(unigram.pa.array([text]))))
        ids, _ = unigram.encode_block(own, block)
        assert ids.tolist() == library.encode(text)
        assert unigram._cut_alone(own, (" " + text.split()[0]).encode()) == unigram.encode_block(
            own, next(iter(unigram.A.blocks(unigram.pa.array([text.split()[0]]))))
        )[0].tolist()
