"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field labels words; it is trained on a small labelled table (some words
around each base span of a bounded sample of documents, and stretches without any) and finds what the patterns
miss: the same data in another writing. So the table holds every stretch twice, as it is and rewritten: its
spans in a writing that no pattern knows (``rewritten``), its other numbers as dates, prices, versions, numbers
that fail their check and the like (``decoy``). Words are decoded by Viterbi, all stretches of a block at once.

A stretch is a word that holds a digit, ``@``, ``+`` or a spelled sign (``[at]``, ``(dot)``) with its neighbours
on both sides; adjoining ones are one. Nothing else can be part of a span, so every text is searched whole.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from visitrec.llm import arrays as A
from visitrec.llm.rows import through_texts
from visitrec.storage import Scratch

KINDS = ("email", "ip", "card", "phone")
#: Labels of words: none, and one for each kind.
LABELS = ("none", *KINDS)

# The base patterns.
_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_HEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Words on each side of a marked word.
NEIGHBOURS = 3
#: Rows of the labelled table, at most; two for each stretch.
SAMPLE = 3000
#: Words of a stretch that training looks at; words that are decoded at once, with what fills up shorter stretches.
STRETCH_WORDS, CELLS = 64, 1 << 15
SHAPES = 1 << 12
#: Score that a feature without any example adds to "none".
UNSEEN = 2.0
#: Code points of a span that the field adds, at most (an address has 320 and may be spelled).
LONGEST = 512

_MARKED = A.byte_table(b"0123456789@+")
_OPENING = A.byte_table(b"[(")
_SPELLED_AT = re.compile(r"[\[(]at[\])]", re.I)
_MARK = re.compile(r"[0-9@+]|[\[(](?:at|dot)[\])]", re.I)
_SPELLED, _SPELLED_BYTES = (re.compile(p, re.I) for p in (r"[\[(](?:at|dot)[\])]", rb"[\[(](?:at|dot)[\])]"))
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LETTERS, _NUMBER = re.compile(r"[^\W\d_]+"), re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_HEAD:
            start -= 1
        tail = _EMAIL_TAIL.match(text, at) if start < at else None
        if tail:
            yield start, tail.end()
            done = tail.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, end and kind (as listed) of what the patterns find, in order."""
    spans = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            spans.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            spans.append((m.start(), m.end(), 3))
    spans.sort(key=lambda s: (s[0], s[2]))
    return spans


def _cut(digits: str, sizes: tuple[int, ...], sign: str) -> str:
    """The digits in groups of these sizes, the last one taking the rest."""
    ends = list(itertools.accumulate(sizes[:-1]))
    return sign.join(digits[a:b] for a, b in zip([0, *ends], [*ends, len(digits)]))


def rewritten(span: str, kind: int, pick: int) -> str:
    """The datum in a writing that the base patterns miss; ``pick`` chooses among some of them.

    Every other address loses its digits, as not all have some. No writing leaves a bare number as a word.
    """
    digits = _digits(span)
    if kind == 0:
        name, host = (_NUMBER.sub("", p).strip("._%+-") or "me" for p in span.split("@")) if pick % 2 else span.split("@")
        at, dot = (("[at]", "[dot]"), ("(at)", "(dot)"), (" @ ", "."), (" [at] ", " [dot] "), ("(at)", "."))[pick % 5]
        return name + at + host.replace(".", dot)
    if kind == 1:
        return span.replace(".", ("[.]", "(.)", "(dot)", "[dot]")[pick % 4])
    if kind == 2:
        return _cut(digits, (4, 4, 4, 4), (".", "/", "_", "--")[pick % 4])
    own, area = digits[-10:], digits[-10:-7]
    return (
        f"({area}) {own[3:6]}-{own[6:]}",
        _cut(own, (3, 3, 4), "-"),
        _cut(own, (3, 3, 4), "."),
        f"00{digits[:-10]}-{_cut(own, (3, 3, 4), '-')}",
        f"{digits[:-10] or 1}-{_cut(own, (3, 3, 4), '-')}",
        f"{area}/{own[3:]}",
    )[pick % 6]


def decoy(pick: int) -> str:
    """A number, handle or the like that is no personal data, though it may look so."""
    r = pick // 20
    long = f"{10**15 + r * 7919 % (9 * 10**15):016}"
    failing = long if not luhn(long) else long[:-1] + str((int(long[-1]) + 1) % 10)
    year, month, day = 1950 + r % 90, r % 12 + 1, r % 28 + 1
    return (
        f"{year}-{month:02}-{day:02}",
        f"{day:02}.{month:02}.{year}",
        f"{month}/{day}/{year}",
        f"{r % 24:02}:{r % 60:02}:{r % 59:02}",
        f"{r % 900}.{r % 100:02}",
        f"{r % 99 + 1},{r % 1000:03}.00",
        f"{r % 9}.{r % 20}.{r % 7}",
        f"{year}-{year + r % 9}",
        _cut(failing, (4, 4, 4, 4), ("./_")[r % 3]),
        _cut(failing, (16,), ""),
        "[.]".join(str(256 + r % (n + 600)) for n in range(4)),
        str(r % 10 ** (r % 9 + 1)),
        f"978-{r % 9}-{r % 100:02}-{r % 10**6:06}-{r % 7}",
        f"@{'abcdefgh'[: r % 7 + 2]}",
        f"({year})" if r % 2 else f"({r % 200})",
        f"AB-{r % 10**4:04}-{r % 1000:03}",
        f"{'abcdefgh'[: r % 7 + 1]}{r % 10 ** (r % 4 + 1)}",
        f"{r % 99 + 1}th",
        f"{r % 10**4}{'abcdefgh'[: r % 7 + 1]}{r % 10**3}",
        f"{r % 99 + 1}%",
    )[pick % 20]


def _reworked(stretch: str, spans: list[tuple[int, int, int]], pick: int) -> tuple[list[str], list[int]]:
    """Words and labels of the stretch with its spans rewritten or, without any, its marked words as decoys."""
    parts, done, at, new = [], 0, 0, []
    if not spans:
        marked = (m.span() for m in _WORD.finditer(stretch) if _is_marked(m[0]))
        spans = [(a, b, -1) for a, b in marked]
    for number, (a, b, kind) in enumerate(spans):
        if a < done:
            continue
        chosen = pick + 7919 * number
        put = decoy(chosen) if kind < 0 else rewritten(stretch[a:b], kind, chosen)
        parts += [stretch[done:a], put]
        at += a - done
        if kind >= 0:
            new.append((at, at + len(put), kind))
        at += len(put)
        done = b
    text = "".join([*parts, stretch[done:]])
    words = [m.span() for m in _WORD.finditer(text)]
    return [text[a:b] for a, b in words], _labels_of(words, new)


def _is_marked(word: str) -> bool:
    return _MARK.search(word) is not None


def _shape(word: str) -> str:
    return _NUMBER.sub(lambda m: f"0{min(len(m[0]), 20)}", _LETTERS.sub("a", word))


@functools.lru_cache(maxsize=1 << 16)
def _code(name: str) -> int:
    data = np.frombuffer(name.encode(), np.uint8)
    if not len(data):
        return 0
    return int(A.span_hashes(data, np.array([0]), np.array([len(data)]))[0]) % SHAPES


_TRIM = "\"'.,;:!?<>[]{}*#&%$|"


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: its shape, that without outer marks and lengths, its digits, signs, check."""
    return _short_features(word) if len(word) <= 64 else _features(word)


def _features(word: str) -> tuple[int, ...]:
    if not _is_marked(word):
        return (_code("plain" if any(c.isalnum() for c in word) else "sign " + word),) * 5
    core = word.strip(_TRIM)
    digits = _digits(core)
    signs = "".join(sorted({c for c in core if not c.isalnum()}))
    parts = _NUMBER.findall(core)
    quad = len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    spelled = _SPELLED.search(word) is not None
    return (
        _code("shape " + _shape(word)),
        _code("core " + _NUMBER.sub("0", _LETTERS.sub("a", core))),
        _code(f"digits {min(len(digits), 20)} {len(digits) == len(core)}"),
        _code("signs " + signs),
        _code(f"check {14 <= len(digits) <= 19 and luhn(digits)} {quad} {spelled} {core.count('@')} {core[:1] == '+'}"),
    )


def stretch_features(words: list[str]) -> list[int]:
    """The features of all words; a word right beside a spelled sign is known as that too."""
    signs = [False, *(word == "@" or _SPELLED.fullmatch(word) is not None for word in words), False]
    out = []
    for i, word in enumerate(words):
        own = word_features(word)
        beside = signs[i] or signs[i + 2]
        out += (*own[:4], _code(f"beside a sign {signs[i]} {signs[i + 2]}")) if beside else own
    return out


#: Words recur; only short ones are held, so the memory is bounded.
_short_features = functools.lru_cache(maxsize=1 << 15)(_features)


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Bounds of the words of each stretch."""
    words, last, pending = [], -NEIGHBOURS - 1, []
    for i, m in enumerate(_WORD.finditer(text)):
        word = m.span()
        if _is_marked(m[0]):
            words += pending[-NEIGHBOURS:]
            pending = []
            words.append(word)
            last = i
        elif i - last <= NEIGHBOURS and words:
            words.append(word)
        else:
            if words and i - last > 2 * NEIGHBOURS:
                yield words
                words = []
            pending.append(word)
            del pending[:-NEIGHBOURS]
    if words:
        yield words


def _labels_of(words: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """For each word the kind, from 1, of the first span over it; words are in order and apart."""
    out, ends = [0] * len(words), [b for _, b in words]
    for start, end, kind in spans:
        i = bisect.bisect_right(ends, start)
        while i < len(words) and words[i][0] < end:
            out[i] = out[i] or kind + 1
            i += 1
    return out


@dataclass(frozen=True)
class CrfModel:
    """Weights of features by label, of label pairs, and of first labels."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray


def labelled_table(documents: DataFrame, sample: int = SAMPLE, stretch_words: int = STRETCH_WORDS) -> DataFrame:
    """Stretches with the labels that the base patterns give: features (5 for each word) and labels.

    ``sample`` rows at most, two for each stretch: as it is and reworked (see the module). Stretches are chosen
    by a hash of their text; those with a span and those without have a half each. Only texts with marked words
    give any. Each task reads its texts once and passes on its own first stretches of either kind, so what is
    ordered is bounded by the number of tasks. Of a longer stretch the first ``stretch_words`` words are taken,
    for training alone.
    """
    half = sample // 4  # stretches of either kind
    scratch = Scratch(documents.sparkSession, "labelled")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: tuple[list, list] = [], []  # heaps, the last of the first stretches on top
        for batch in batches:
            for _, _, text in _marked_texts(batch):
                spans = base_spans(text)
                for words in stretches(text):
                    words = words[:stretch_words]
                    own = _labels_of(words, spans)
                    heap = first[any(own)]
                    stretch = text[words[0][0] : words[-1][1]]
                    rank = _rank(stretch)
                    if len(heap) < half or heap and -rank > heap[0][0]:
                        begin, end = words[0][0], words[-1][1]
                        inside = [(a - begin, b - begin, k) for a, b, k in _within(spans, begin, end)]
                        entry = (-rank, stretch, [text[a:b] for a, b in words], own, inside)
                        (heapq.heappush if len(heap) < half else heapq.heapreplace)(heap, entry)
            A.give_back()
        rows = [(found, entry) for found, heap in enumerate(first) for entry in heap]
        other = [_reworked(e[1], e[4], -e[0] // 3) for _, e in rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([bool(found) for found, _ in rows], pa.bool_()),
                pa.array([-e[0] for _, e in rows], pa.int64()),
                pa.array([stretch_features(e[2]) for _, e in rows], pa.list_(pa.int32())),
                pa.array([e[3] for _, e in rows], pa.list_(pa.int32())),
                pa.array([stretch_features(words) for words, _ in other], pa.list_(pa.int32())),
                pa.array([labels for _, labels in other], pa.list_(pa.int32())),
            ],
            names=["found", "rank", "features", "labels", "new_features", "new_labels"],
        )

    rows = scratch.keep(
        documents.select("text").mapInArrow(
            cut,
            "found boolean, rank long, features array<int>, labels array<int>, "
            "new_features array<int>, new_labels array<int>",
        ),
        "stretches",
    )
    order = ["rank", "features", "labels"]
    found = rows.filter("found").orderBy(*order).limit(half)
    other = rows.filter("NOT found").orderBy(*order).limit(half)
    chosen = found.union(other)
    return chosen.select("features", "labels").union(chosen.select("new_features", "new_labels"))


def _within(spans: list[tuple[int, int, int]], begin: int, end: int) -> list[tuple[int, int, int]]:
    """The spans, which are in order, that lie between two places."""
    out = []
    for a, b, kind in spans[bisect.bisect_left(spans, (begin, 0, 0)) :]:
        if a >= end:
            break
        if b <= end:
            out.append((a, b, kind))
    return out


def _rank(stretch: str) -> int:
    return zlib.crc32(stretch.encode())


def _marked_texts(batch: pa.RecordBatch) -> Iterator[tuple[A.Block, int, str]]:
    """Row number and text of the rows that hold a digit, ``@``, ``+`` or a spelled sign."""
    for block in A.blocks(batch.column("text")):
        hits = np.add.reduceat(_MARKED[block.data], block.starts, dtype=np.int64)
        opening = np.add.reduceat(_OPENING[block.data], block.starts, dtype=np.int64)
        for k in np.flatnonzero(hits + opening).tolist():
            data = block.data[block.starts[k] : block.ends[k]].tobytes()
            if hits[k] or _SPELLED_BYTES.search(data):
                yield block, block.first + k, data.decode()


def _padded(rows: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all stretches, -1 beyond their end, and their lengths."""
    lengths = np.array([len(r) // 5 for r in rows], dtype=np.int64)
    out = np.full((len(rows), int(lengths.max(initial=0)), 5), -1, dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : lengths[i]] = np.asarray(r, dtype=np.int64).reshape(-1, 5)
    return out, lengths


def _scores(model: CrfModel, features: np.ndarray) -> np.ndarray:
    return model.emit[np.maximum(features, 0)].sum(axis=-2)


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train_crf(rows: list, rounds: int = 120, rate: float = 0.1, decay: float = 1e-4) -> CrfModel:
    """Maximum likelihood by forward and backward sums over all stretches at once, with Adam's steps.

    ``rows`` have features and labels. Without rows the model labels nothing.
    """
    k = len(LABELS)
    model = CrfModel(np.zeros((SHAPES, k)), np.zeros((k, k)), np.zeros(k))
    if not rows:
        model.first[0], model.move[:, 0] = 1.0, 1.0
        return model
    x, lengths = _padded([r.features for r in rows])
    n, width = x.shape[:2]
    y = np.zeros((n, width), dtype=np.int64)
    for i, r in enumerate(rows):
        y[i, : lengths[i]] = r.labels
    live = np.arange(width)[None, :] < lengths[:, None]
    truth = np.eye(k)[y] * live[:, :, None]
    pairs = live[:, 1:]
    true_moves = np.einsum("ntk,ntl->kl", truth[:, :-1] * pairs[:, :, None], truth[:, 1:])
    used = np.maximum(x, 0)
    params = [model.emit, model.move, model.first]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, rounds + 1):
        score = _scores(model, x)
        ahead = np.empty_like(score)
        ahead[:, 0] = score[:, 0] + model.first
        for t in range(1, width):
            reach = _logsum(ahead[:, t - 1, :, None] + model.move[None], 1) + score[:, t]
            ahead[:, t] = np.where(live[:, t, None], reach, ahead[:, t - 1])
        total = _logsum(ahead[:, -1], 1)
        back = np.zeros_like(score)
        moves = np.zeros((k, k))
        for t in range(width - 2, -1, -1):
            onward = model.move[None] + (score[:, t + 1] + back[:, t + 1])[:, None, :]
            back[:, t] = np.where(pairs[:, t, None], _logsum(onward, 2), 0)
            both = np.exp(ahead[:, t, :, None] + onward - total[:, None, None])
            moves += (both * pairs[:, t, None, None]).sum(axis=0)
        chance = np.exp(ahead + back - total[:, None, None]) * live[:, :, None]
        gap = (chance - truth) / n
        emit = np.zeros_like(model.emit)
        for label in range(k):
            each = np.repeat(gap[:, :, label].ravel(), 5)
            emit[:, label] = np.bincount(used.ravel(), each * np.repeat(live.ravel(), 5), SHAPES)
        slopes = [emit, (moves - true_moves) / n, gap[:, 0].sum(axis=0)]
        for p, slope, (mean, square) in zip(params, slopes, state):
            slope = slope + decay * p
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope * slope - square)
            p -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    seen = np.bincount(used[live].ravel(), minlength=SHAPES) > 0
    model.emit[~seen, 0] += UNSEEN
    return model


def viterbi(model: CrfModel, rows: list[list]) -> list[np.ndarray]:
    """The likeliest labels of each stretch; stretches of like length are decoded together, ``CELLS`` words at a time."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(rows)
    order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
    at = 0
    while at < len(order):
        last = at + 1
        while last < len(order) and (last + 1 - at) * len(rows[order[last]]) <= 5 * CELLS:
            last += 1
        chosen, at = order[at:last], last
        x, lengths = _padded([rows[i] for i in chosen])
        score = _scores(model, x)
        n, width = x.shape[:2]
        best, back = score[:, 0] + model.first, np.zeros((n, width, len(LABELS)), dtype=np.int64)
        finals = np.where((lengths == 1)[:, None], best, 0.0)
        for t in range(1, width):
            reach = best[:, :, None] + model.move[None]
            back[:, t] = reach.argmax(axis=1)
            best = reach.max(axis=1) + score[:, t]
            finals = np.where((lengths == t + 1)[:, None], best, finals)
        label = finals.argmax(axis=1)
        path = np.zeros((n, width), dtype=np.int64)
        for t in range(width - 1, -1, -1):
            inside = t < lengths
            path[inside, t] = label[inside]
            label = np.where(inside & (t > 0), back[np.arange(n), t, label], label)
        for i, row in enumerate(chosen):
            out[row] = path[i, : lengths[i]]
    return out


def fit_crf(documents: DataFrame, sample: int = SAMPLE) -> CrfModel:
    return train_crf(labelled_table(documents, sample).collect())


def _possible(span: str, kind: int) -> bool:
    """Whether the span has the signs, numbers or digits that its kind needs, in any writing."""
    if len(span) > LONGEST:
        return False
    if kind == 0:
        return "@" in span.strip("@") or _SPELLED_AT.search(span) is not None
    if _LETTERS.search(_SPELLED.sub("", span)):
        return False
    if kind == 1:
        parts = _NUMBER.findall(span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    digits = _digits(span)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 7 <= len(digits) <= 15


def _added(
    text: str, words: list[tuple[int, int]], labels: np.ndarray, base: list[tuple[int, int, int]]
) -> list[tuple[int, int, int]]:
    """Runs of words with one label, without outer marks, that touch no base span (these are in order).

    A run must have what its kind consists of (``_possible``).
    """
    out, i = [], 0
    starts = [s for s, _, _ in base]
    reach = list(itertools.accumulate((e for _, e, _ in base), max))
    while i < len(words):
        j = i + 1
        while j < len(words) and labels[j] == labels[i] and words[j][0] - words[j - 1][1] <= 2:
            j += 1
        if labels[i]:
            start, end = words[i][0], words[j - 1][1]
            while start < end and text[start] in _TRIM:
                start += 1
            while end > start and text[end - 1] in _TRIM:
                end -= 1
            before = bisect.bisect_left(starts, end)
            apart = not (before and reach[before - 1] > start)
            if start < end and apart and _possible(text[start:end], int(labels[i]) - 1):
                out.append((start, end, int(labels[i]) - 1))
        i = j
    return out


def _block_spans(texts: list[str], model: CrfModel) -> list[tuple[list, list]]:
    """Base spans and all spans of some texts."""
    base = [base_spans(t) for t in texts]
    found = [(k, words) for k, text in enumerate(texts) for words in stretches(text)]
    rows = [stretch_features([texts[k][a:b] for a, b in words]) for k, words in found]
    spans = [list(b) for b in base]
    for (k, words), labels in zip(found, viterbi(model, rows)):
        if labels.any():
            spans[k] += _added(texts[k], words, labels, base[k])
    for s in spans:
        s.sort(key=lambda x: (x[0], x[2], x[1]))
    return list(zip(base, spans))


_SPANS = "array<struct<start:int,end:int,kind:string>>"


def find_pii(documents: DataFrame, model: CrfModel) -> DataFrame:
    """Personal data in every row of ``documents`` (doc_id, text).

    Returns doc_id, base and spans: start, end and kind of what the patterns find, and of that with what the
    field adds, in code points. A null or empty text has none. Rows that repeat a doc_id are searched one by
    one; other columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for batch in batches:
            found = {}
            for rows in _grouped(_marked_texts(batch)):
                pairs = _block_spans([text for _, text in rows], shared.value)
                found.update({row: pair for (row, _), pair in zip(rows, pairs)})
            columns = [
                pa.array(
                    [
                        [{"start": s, "end": e, "kind": KINDS[c]} for s, e, c in found.get(i, ((), ()))[side]]
                        for i in range(len(batch))
                    ],
                    kind,
                )
                for side in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "base", "spans"]
            )

    schema = T.StructType([documents.schema["doc_id"], *T.StructType.fromDDL(f"base {_SPANS}, spans {_SPANS}").fields])
    return documents.select("doc_id", "text").mapInArrow(search, schema)


def _grouped(texts: Iterator[tuple[A.Block, int, str]]) -> Iterator[list[tuple[int, str]]]:
    """The texts of one block at a time."""
    current, rows = None, []
    for block, row, text in texts:
        if block is not current and rows:
            yield rows
            rows = []
        current = block
        rows.append((row, text))
    if rows:
        yield rows


def redacted(documents: DataFrame, model: CrfModel) -> DataFrame:
    """All rows and columns, each span of the text replaced by its kind in angle brackets.

    Overlapping spans are replaced as one, under the kind of the first. A null text stays null.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def redact(rows: pa.RecordBatch, place: int) -> pa.RecordBatch:
        texts = pa.RecordBatch.from_arrays([rows.column(place)], names=["text"])
        out = rows.column(place).to_pylist()
        for marked in _grouped(_marked_texts(texts)):
            pairs = _block_spans([text for _, text in marked], shared.value)
            for (row, text), (_, spans) in zip(marked, pairs):
                out[row] = _with_kinds(text, spans)
        columns = rows.columns
        columns[place] = pa.array(out, rows.schema.field(place).type)
        return pa.RecordBatch.from_arrays(columns, schema=rows.schema)

    return through_texts(documents, redact)


def _with_kinds(text: str, spans: list[tuple[int, int, int]]) -> str:
    parts, done, last = [], 0, -1
    for start, end, kind in spans:
        if start < last:
            done = last = max(last, end)
            continue
        parts += [text[done:start], f"<{KINDS[kind]}>"]
        done = last = end
    return "".join([*parts, text[done:]])
