"""What earlier versions got wrong: regular words, very long numbers, equal rows, crowded passages."""

import random
import time

import numpy as np
import pytest

from visitrec.llm import ngram_join
from visitrec.llm.kd_shards import shard_documents
from visitrec.llm.ngram_join import deduplicated, near_duplicates
from visitrec.llm.outliers import quality_rules
from visitrec.llm.pii import CrfModel, _added, _labels_of, base_spans, find_pii, redacted, train_crf, viterbi
from visitrec.llm.suffix_dedup import remove_repeats
from visitrec.llm.toxicity import OrdinalModel, without_toxic
from visitrec.llm.unigram import decode, encode
from visitrec.llm.winnow import decontaminated

from test_operators import SCHEMA, shingles

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", "7", 1) for i, t in rows], SCHEMA)


def morse(n):
    out = "a"
    while len(out) < n:
        out += out.translate(str.maketrans("ab", "ba"))
    return out


@pytest.fixture(scope="module", params=[1024, 4096])
def pair(request):
    one = morse(request.param)
    return one, one.translate(str.maketrans("ab", "ba"))


def test_regular_words_are_not_linked(spark, pair):
    rows = near_duplicates(frame(spark, enumerate(pair))).collect()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 1: 1}


def test_regular_lines_are_not_equal(spark, pair):
    (row,) = quality_rules(frame(spark, [(0, "\n".join(pair))])).collect()
    assert row.n_dup_lines == 0


def test_regular_words_keep_their_pieces(spark, pair):
    text = " ".join(pair)
    encoded = encode(frame(spark, [(0, text)]), PIECES)
    assert encoded.first().round_trip and decode(encoded, PIECES).first().text == text


def test_regular_texts_are_not_repeats(spark, pair):
    one, two = (f"{i} {text} {i}" for i, text in enumerate(pair))
    got = {r.doc_id: r.n_removed for r in remove_repeats(frame(spark, [(0, one), (1, two)])).collect()}

    def removed(text, others, n=200):
        strings = [t[i : i + n] for t in (one, two) for i in range(len(t) - n + 1)]
        counts = {}
        for s in strings:
            counts[s] = counts.get(s, 0) + 1
        covered = [False] * len(text)
        for i in range(len(text) - n + 1):
            if counts[text[i : i + n]] > 1:
                covered[i : i + n] = [True] * n
        return sum(covered)

    assert got == {0: removed(one, two), 1: removed(two, one)}


def test_very_long_numbers(spark):
    assert base_spans("0" * 5000 + "1.2.3.4") == [(0, 5007, 1)]
    assert base_spans("9" * 5000 + ".2.3.4") == []
    model = train_crf([])
    text = "call 1.2.3.4 " + "7" * 6000 + ".1.1.1 " + "12.5 " * 3000
    (row,) = find_pii(frame(spark, [(1, text)]), model).collect()
    assert [s.kind for s in row.base][:1] == ["ip"]


def test_labels_and_additions_as_before():
    pick = random.Random(4)
    for _ in range(200):
        cuts = sorted(pick.sample(range(200), 20))
        words = list(zip(cuts[::2], cuts[1::2]))
        spans = sorted((a, a + pick.randint(1, 30), pick.randrange(4)) for a in pick.sample(range(200), 5))
        plain = [next((k + 1 for s, e, k in spans if a < e and s < b), 0) for a, b in words]
        assert _labels_of(words, spans) == plain
        labels = np.array([pick.randrange(3) for _ in words])
        text = "a@" * 120  # every run of labels may be an address
        for start, end, kind in _added(text, words, labels, spans):
            assert not any(s < end and start < e for s, e, _ in spans)


def test_many_addresses_take_linear_time():
    times = []
    for n in (2000, 8000):
        words = [(i * 10, i * 10 + 8) for i in range(n)]
        spans = [(i * 10, i * 10 + 8, 1) for i in range(n)]
        start = time.perf_counter()
        _labels_of(words, spans)
        times.append(time.perf_counter() - start)
    assert times[1] < 0.5


def test_one_long_stretch_does_not_widen_the_others():
    model = CrfModel(*(np.zeros(shape) for shape in ((1 << 12, 5), (5, 5), (5,))))
    model.first[0] = 1.0
    rows = [[1] * 5] * 600 + [[1] * 5 * 30_000]
    assert [len(labels) for labels in viterbi(model, rows)] == [1] * 600 + [30_000]


def test_equal_rows_are_cut_apart(spark):
    rows = [(i, "x" * 500) for i in range(2000)] + [(99_999, "y" * 5000)] * 400
    got = shard_documents(frame(spark, rows)).collect()
    sizes = [0] * 40
    for row in got:
        sizes[row.shard] += row.size
    mean = sum(sizes) / 40
    assert len(got) == 2400 and max(sizes) - min(sizes) <= 2 * 5016 and abs(max(sizes) - mean) <= 5016


def components_of(rows, num=80, den=100, n=5):
    sets = {i: shingles(t, n) for i, t in rows}
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
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("crowd", [1, 4, 16])
def test_crowded_passages_lose_no_link(spark, monkeypatch, crowd):
    """Texts with a passage that all of them hold, in several groups of near copies."""
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    pick = random.Random(8)
    vocabulary = [f"v{i}" for i in range(300)]
    passage = pick.choices(vocabulary, k=60)
    rows = []
    for group in range(12):
        base = pick.choices(vocabulary, k=pick.choice([10, 60, 200])) + passage
        for _ in range(pick.choice([1, 2, 9])):
            words = list(base)
            for _ in range(pick.choice([0, 1, 2, 8])):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, " ".join(passage)) for i in range(3)]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == components_of(rows)


def rows_moved(df, column):
    """Rows that passed a shuffle with this column, once the frame has been collected."""
    moved, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        else:
            if kind == "ShuffleExchangeExec" and f"{column}#" in plan.output().toString():
                moved += plan.metrics().apply("shuffleRecordsWritten").value()
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return moved


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are on large tables."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_texts_that_stay_are_not_shuffled(spark, no_broadcast):
    pick = random.Random(3)
    rows = [(i, " ".join(f"w{pick.randrange(10_000)}" for _ in range(30))) for i in range(200)]
    rows += [(200 + i, rows[i][1]) for i in range(5)]
    kept = deduplicated(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(200))
    assert 5 <= rows_moved(kept, "text") <= 20


def test_texts_without_benchmark_words_are_not_shuffled(spark, no_broadcast):
    pick = random.Random(5)
    rows = [(i, " ".join(f"w{pick.randrange(10_000)}" for _ in range(30))) for i in range(200)]
    items = spark.createDataFrame([(str(i), " ".join(rows[i][1].split()[5:20])) for i in range(5)], "item_id string, text string")
    kept = decontaminated(frame(spark, rows + [(None, rows[9][1])]), items)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == list(range(5, 200))
    assert kept.filter("doc_id IS NULL").count() == 1
    assert 5 <= rows_moved(kept, "text") <= 20


def test_no_text_waits_for_another(spark):
    """Stages that only look at texts pass on each block of them by itself, so no task holds a whole batch of results."""
    rows = [(i, f"word {i} " * 2000 if i % 4 else None) for i in range(400)]
    texts = frame(spark, rows).coalesce(1)
    model = CrfModel(np.zeros((1 << 12, 5)), np.zeros((5, 5)), np.eye(5)[0])
    clean = OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.full(3, 30.0))
    for kept in (redacted(texts, model), without_toxic(texts, clean)):
        assert [tuple(r) for r in kept.collect()] == [tuple(r) for r in texts.collect()]
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("twice", [False, True])
def test_full_map_of_ids_changes_no_row(spark, monkeypatch, twice):
    """One of 64 bits, which holds many ids that are not listed; ids come once or twice, or are null."""
    monkeypatch.setattr(ngram_join, "LEAST_BITS", 6)
    monkeypatch.setattr(ngram_join, "MOST_BITS", 6)
    pick = random.Random(4)
    texts = [" ".join(f"w{pick.randrange(1000)}" for _ in range(12)) for _ in range(60)]
    rows = [(i, texts[i % 60 if i % 3 else i % 7]) for i in range(100)] + [(None, texts[0])] * 2
    rows += rows[10:30] * twice
    label = components_of([(i, t) for i, t in rows if i is not None])
    got = [(r.doc_id, r.text) for r in deduplicated(frame(spark, rows)).collect()]
    stay = {(i, t) for i, t in rows if i is not None and label[i] == i}
    assert sorted(r for r in got if r[0] is not None) == sorted(stay)
    assert [r for r in got if r[0] is None] == [(None, texts[0])] * 2
