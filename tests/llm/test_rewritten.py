"""What the field finds beyond the patterns, on documents that it was not trained on."""

import zlib
from collections import Counter

import pytest

from visitrec.llm.pii import (
    KINDS,
    _block_spans,
    _reworked,
    base_spans,
    decoy,
    fit_crf,
    find_pii,
    rewritten,
    stretch_features,
    stretches,
)

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def halves(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_crf(documents.filter("doc_id % 2 = 0"))
    held_out = documents.filter("doc_id % 2 = 1 AND text RLIKE '[0-9@+]'").select("doc_id", "text").collect()
    return model, held_out


def _with_rewritten_spans(row):
    parts, done, at, spans = [], 0, 0, []
    for number, (a, b, kind) in enumerate(base_spans(row.text)):
        if a < done:
            continue
        put = rewritten(row.text[a:b], kind, zlib.crc32(f"{row.doc_id}:{number}".encode()))
        parts += [row.text[done:a], put]
        at += a - done
        spans.append((at, at + len(put), kind))
        at += len(put)
        done = b
    return "".join([*parts, row.text[done:]]), spans


def test_patterns_miss_what_is_rewritten():
    samples = ["a.b@c.example.com", "10.20.30.40", "4111 1111 1111 1111", "+1 (743) 555-3824"]
    for kind, text in enumerate(samples):
        for pick in range(12):
            put = rewritten(text, kind, pick)
            assert not [s for s in base_spans(f"so {put} then") if s[2] == kind and s[1] - s[0] == len(put)], put
    assert not any(base_spans(f"so {decoy(pick)} then") for pick in range(3, 60_000, 7))


def test_held_out_spans_in_other_writings_are_found_whole(halves):
    model, held_out = halves
    there, found = Counter(), Counter()
    for row in held_out:
        text, spans = _with_rewritten_spans(row)
        ((_, all_spans),) = _block_spans([text], model)
        for a, b, kind in spans:
            there[kind] += 1
            found[kind] += any(x <= a + 1 and b - 1 <= y and k == kind for x, y, k in all_spans)
    assert set(there) == set(range(len(KINDS)))
    assert all(found[kind] >= 0.9 * there[kind] for kind in there), (there, found)


def test_held_out_documents_as_they_are_get_hardly_any_span_more(halves):
    model, held_out = halves
    pairs = [_block_spans([row.text], model)[0] for row in held_out]
    added = sum(len(spans) - len(base) for base, spans in pairs)
    assert added <= 0.02 * sum(len(base) for base, _ in pairs)


def test_decoys_are_left_alone(halves):
    model, _ = halves
    texts = [f"the words of {decoy(pick)} are here and there" for pick in range(1, 90_000, 89)]
    wrong = [t for t, (_, spans) in zip(texts, _block_spans(texts, model)) if spans]
    assert len(wrong) <= 0.03 * len(texts), wrong[:20]


def test_spelled_signs_mark_a_text_without_digits(spark, halves):
    model, _ = halves
    text = "please write to jane(at)mail(dot)example(dot)com before noon"
    rows = spark.createDataFrame([(1, text), (2, "see [1] at (dotted) lines"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in find_pii(rows, model).collect()}
    assert got[1].base == [] and [(s.start, s.end, s.kind) for s in got[1].spans] == [(16, 48, "email")]
    assert got[2].spans == [] and got[3].spans == []


def test_reworked_stretch_keeps_words_and_labels_in_step():
    text = "one two 10.20.30.40 three 4111111111111111 four"
    spans = base_spans(text)
    for pick in range(12):
        words, labels = _reworked(text, spans, pick)
        assert len(words) == len(labels) and set(labels) == {0, 2, 3}
        assert words[:2] == ["one", "two"] and labels[:2] == [0, 0] and labels[-1] == 0
        assert len(stretch_features(words)) == 5 * len(words)
    words, labels = _reworked("chapter 12 of 30", [], 5)
    assert not any(labels)
    assert list(stretches("nothing to see")) == []


def test_runs_of_numbers_are_no_spans(halves):
    model, _ = halves
    texts = [" ".join(f"word{i}" for i in range(3000)), " ".join(map(str, range(3000))), "12 13 2019 4.5 7% " * 400]
    assert [spans for _, spans in _block_spans(texts, model)] == [[], [], []]
