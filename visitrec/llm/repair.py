"""Conversation structure repair: the cheapest edits by dynamic programming over grammar-compressed rows.

1. Each row becomes a symbol of its role and its fault. A conversation's symbols are cut into chunks of
   ``CHUNK`` rows; equal chunks are kept once.
2. Re-Pair: rounds count neighbouring symbols over all chunks, and frequent pairs become rules. A round takes
   all pairs that cannot overlap, so that the number of rounds grows with the logarithm of a chunk's length.
3. A symbol is a min-plus matrix over the states of the wanted pattern: the cost of going from one state to
   another, with the audit of its edits as a rope. A rule's matrix is the product of its two parts; it is
   evaluated once, bottom-up, for all conversations that hold it.
4. A chunk's matrix is the product of what is left of it; a conversation's, that of its chunks.
5. The rows of a conversation stream by in order and are edited as the audit says.

The rows of one conversation pass through one task, sorted and spilled by Spark but never gathered: the digest of a
repaired conversation is one hash over all its rows. Chunks bound what is held of a sequence.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from visitrec.storage import Scratch

#: Costs of edits.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5
#: Rows of a chunk; rules of the grammar. What no rule covers is multiplied symbol by symbol.
CHUNK, RULES = 4096, 256
#: Rows of a batch that a task hands back.
BATCH = 1000

#: Row symbols: roles s, u, a and any other, upper case if the text is truncated; d must be deleted.
SYMBOLS = "suaxSUAXd"
#: The pattern (s?(ua)+)?: nothing yet, after s, after u, after a. It may end in the first and the last.
STATES, ENDS = 4, (0, 3)
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The role that an inserted or re-roled row must have in a state.
_FITTING = {0: ("u", "user"), 1: ("u", "user"), 2: ("a", "assistant"), 3: ("u", "user")}

_SPACES = " \t\n\x0b\x0c\r"


class Rope:
    """A text put together from shared parts; read only when it is compared or written."""

    __slots__ = ("left", "right", "size", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None) -> None:
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if left is None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        return Rope(left=self, right=other) if other.size else self

    def __str__(self) -> str:
        out, stack = [], [self]
        while stack:
            rope = stack.pop()
            if rope.left is None:
                out.append(rope.text)
            else:
                stack += [rope.right, rope.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """Order of the texts; parts that both share at the same place are not read."""
        one, two = [self], [other]
        while one and two:
            a, b = one.pop(), two.pop()
            if a is b:
                continue
            if a.left is not None and (a.size >= b.size or b.left is None):
                one += [a.right, a.left]
                two.append(b)
            elif b.left is not None:
                two += [b.right, b.left]
                one.append(a)
            else:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text[:n] < b.text[:n]
                if a.size > n:
                    one.append(Rope(a.text[n:]))
                if b.size > n:
                    two.append(Rope(b.text[n:]))
        return bool(two) and any(rope.size for rope in two)


#: By two states: the least cost between them and its audit, least in ASCII order, or None.
Matrix = list[list[tuple[int, Rope] | None]]


def better(one: tuple[int, Rope] | None, two: tuple[int, Rope] | None) -> tuple[int, Rope] | None:
    """The cheaper one, or of equal ones that with the lesser audit.

    Of two audits of the same rows and of equal cost none is the beginning of the other, as the longer one would hold
    more insertions; so the order of parts decides the order of wholes.
    """
    if one is None or two is None:
        return one or two
    if one[0] != two[0]:
        return one if one[0] < two[0] else two
    return two if two[1] < one[1] else one


def times(one: Matrix, two: Matrix) -> Matrix:
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for p in range(STATES):
        for m in range(STATES):
            if (first := one[p][m]) is None:
                continue
            for q in range(STATES):
                if (second := two[m][q]) is not None:
                    out[p][q] = better(out[p][q], (first[0] + second[0], first[1] + second[1]))
    return out


def identity() -> Matrix:
    return [[(0, Rope()) if p == q else None for q in range(STATES)] for p in range(STATES)]


def insertions() -> Matrix:
    """Any number of inserted rows."""
    out = identity()
    for p in range(STATES):
        at, cost, audit = p, 0, ""
        while out[p][at := _NEXT[at, _FITTING[at][0]]] is None:
            cost, audit = cost + INSERT, audit + "I"
            out[p][at] = (cost, Rope(audit))
    return out


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions, then one edit of a row."""
    edit: Matrix = [[None] * STATES for _ in range(STATES)]
    extra = LEFT_TRUNCATED if symbol.isupper() else 0
    for p in range(STATES):
        edit[p][p] = (DELETE, Rope("D"))
        if symbol == "d":
            continue
        fitting = _NEXT[p, _FITTING[p][0]]
        edit[p][fitting] = better(edit[p][fitting], (REROLE + extra, Rope("R")))
        if (kept := _NEXT.get((p, symbol.lower()))) is not None:
            edit[p][kept] = better(edit[p][kept], (extra, Rope("K")))
    return times(insertions(), edit)


class Grammar:
    """Rules in rounds. Rule i is symbol ``len(SYMBOLS) + i``."""

    def __init__(self, rounds: Sequence[Sequence[tuple[int, int]]] = ()) -> None:
        self.rounds = [list(pairs) for pairs in rounds]

    @property
    def rules(self) -> list[tuple[int, int]]:
        return [pair for pairs in self.rounds for pair in pairs]

    def compressed(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all texts one after the other, and whose each is."""
        codes = np.full(256, -1, dtype=np.int32)
        codes[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
        symbols = codes[np.frombuffer("".join(texts).encode("ascii"), np.uint8)]
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        known = len(SYMBOLS)
        for pairs in self.rounds:
            rule_of = np.full((known, known), -1, dtype=np.int32)
            for i, (left, right) in enumerate(pairs):
                rule_of[left, right] = known + i
            known += len(pairs)
            if len(symbols) < 2:
                continue
            found = np.where(owner[1:] == owner[:-1], rule_of[symbols[:-1], symbols[1:]], -1)
            hits = np.flatnonzero(found >= 0)
            if not len(hits):
                continue
            # only pairs of a symbol with itself overlap: in such a run every other one counts
            first = np.append(True, np.diff(hits) > 1)
            run_start = np.maximum.accumulate(np.where(first, hits, 0))
            hits = hits[(hits - run_start) % 2 == 0]
            symbols = symbols.copy()
            symbols[hits] = found[hits]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hits + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return symbols, owner

    def matrices(self) -> list[Matrix]:
        out = [symbol_matrix(symbol) for symbol in SYMBOLS]
        for left, right in self.rules:
            out.append(times(out[left], out[right]))
        return out


def choose_pairs(counts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs by falling count, those that cannot overlap: no symbol is on both sides."""
    lefts: set[int] = set()
    rights: set[int] = set()
    out = []
    for left, right in counts:
        if left == right:
            fits = left not in lefts and left not in rights
        else:
            fits = left not in rights and right not in lefts
        if fits:
            lefts.add(left)
            rights.add(right)
            out.append((left, right))
    return out


def fit_grammar(sequences: DataFrame, rules: int = RULES) -> Grammar:
    """Re-Pair over a table of symbol texts (column ``symbols``).

    Pairs are counted by every task and summed; the driver gets no more of them than rules may still be made.
    It ends when no pair occurs twice or ``rules`` are there.
    """
    grammar = Grammar()
    while (left_over := rules - len(grammar.rules)) > 0:

        def pair_counts(batches: Iterator[pa.RecordBatch], grammar: Grammar = grammar) -> Iterator[pa.RecordBatch]:
            known = len(SYMBOLS) + len(grammar.rules)
            totals = np.zeros(known * known, dtype=np.int64)
            for batch in batches:
                symbols, owner = grammar.compressed(batch.column("symbols").to_pylist())
                if len(symbols) > 1:
                    inside = owner[1:] == owner[:-1]
                    pairs = (symbols[:-1].astype(np.int64) * known + symbols[1:])[inside]
                    totals += np.bincount(pairs, minlength=known * known)
            at = np.flatnonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at // known), pa.array(at % known), pa.array(totals[at])], names=["a", "b", "n"]
            )

        found = (
            sequences.select("symbols")
            .mapInArrow(pair_counts, "a long, b long, n long")
            .groupBy("a", "b")
            .agg(F.sum("n").alias("n"))
            .filter("n > 1")
            .orderBy(F.desc("n"), "a", "b")
            .limit(left_over)
            .collect()
        )
        pairs = choose_pairs([(row["a"], row["b"]) for row in found])
        if not pairs:
            break
        grammar = Grammar([*grammar.rounds, pairs])
    return grammar


def _multiply(rules: list[list[tuple[int, int]]]):
    """The matrix of each text of symbols, row by row, as costs and audits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        shared = grammar.matrices()
        for batch in batches:
            texts = batch.column("symbols").to_pylist()
            symbols, owner = grammar.compressed(texts)
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
            listed = symbols.tolist()
            out = []
            for a, b in zip(bounds, bounds[1:]):
                matrix = shared[listed[a]] if b > a else identity()
                for symbol in listed[a + 1 : b]:
                    matrix = times(matrix, shared[symbol])
                cells = [cell for row in matrix for cell in row]
                out.append([cell and {"cost": cell[0], "audit": str(cell[1])} for cell in cells])
            kind = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("symbols"), pa.array(out, kind)], names=["symbols", "matrix"]
            )

    return scan


def _follow(matrices: Column) -> Column:
    """From the first state through all matrices: the cheapest way to each state, as (cost, audit)."""
    way = "struct<cost:bigint,audit:string>"
    start = F.array(
        F.struct(F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit")).cast(way),
        *[F.lit(None).cast(way)] * (STATES - 1),
    )

    def step(ways: Column, matrix: Column) -> Column:
        return F.array(
            *[
                F.array_min(F.array(*[_joined(ways[p], matrix[p * STATES + q]) for p in range(STATES)]))
                for q in range(STATES)
            ]
        )

    return F.aggregate(matrices, start, step)


def _joined(one: Column, two: Column) -> Column:
    cost, audit = one["cost"] + two["cost"], F.concat(one["audit"], two["audit"])
    return F.when(one.isNotNull() & two.isNotNull(), F.struct(cost.alias("cost"), audit.alias("audit")))


def _ended(ways: Column) -> Column:
    """The cheapest way to an end, with insertions where they are needed."""
    closing = insertions()
    ends = [
        _joined(
            ways[p],
            F.struct(
                F.lit(closing[p][q][0]).cast("long").alias("cost"), F.lit(str(closing[p][q][1])).alias("audit")
            ),
        )
        for p in range(STATES)
        for q in ENDS
        if closing[p][q] is not None
    ]
    return F.array_min(F.array(*ends))


def _judged(rows: DataFrame) -> DataFrame:
    """Rows in order with their symbol and marks; one shuffle by conversation, windows that stream and spill."""
    rows = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).repartition("conv_id")
    ordered = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    same = Window.partitionBy("conv_id", "role", "text").orderBy("at")
    body = F.rtrim(F.col("text"), F.lit(_SPACES))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    fault = (
        F.when(body == "", "blank")
        .when(F.col("copy") > 1, "duplicate")
        .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    pair = F.concat(F.lag(initial).over(ordered), initial)
    rows = rows.select(
        "*",
        F.row_number().over(ordered).cast("long").alias("at"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(ordered))).alias("new_turn"),
        F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
    )
    rows = rows.withColumn("copy", F.row_number().over(same)).withColumn("fault", fault)
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "at",
        "fault",
        F.when(F.col("fault").isin("blank", "duplicate"), "d")
        .when(F.col("fault") == "truncated", F.upper(known))
        .otherwise(known)
        .alias("symbol"),
        "new_turn",
        "illegal",
    )


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _audited(rows: DataFrame, every: DataFrame, scratch: Scratch, chunk: int, rules: int) -> DataFrame:
    """A row for each conversation: counts, cost and audit."""

    def number(condition: Column) -> Column:
        return F.sum(condition.cast("long"))

    cut = rows.withColumn("chunk", F.floor((F.col("at") - 1) / chunk))
    symbols = F.array_sort(F.collect_list(F.struct("at", "symbol")))
    chunks = cut.groupBy("conv_id", "chunk").agg(
        F.array_join(F.transform(symbols, lambda x: x["symbol"]), "").alias("symbols"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        number(F.col("new_turn")).alias("turns"),
        *(number(F.coalesce(F.col("fault") == f, F.lit(False))).alias(f) for f in _COUNTS[:3]),
        number(F.col("illegal")).alias("illegal"),
    )
    zero = F.lit(0).cast("long")
    # each conversation once more with an empty chunk, so that those without rows are there
    empty = every.select("conv_id").distinct().select(
        "conv_id",
        F.lit(-1).cast("long").alias("chunk"),
        F.lit("").alias("symbols"),
        F.lit(None).cast(rows.schema["turn"].dataType).alias("low"),
        F.lit(None).cast(rows.schema["turn"].dataType).alias("high"),
        zero.alias("turns"),
        *(zero.alias(name) for name in _COUNTS),
    )
    chunks = scratch.keep(chunks.unionByName(empty), "chunks")
    sequences = scratch.keep(chunks.select("symbols").distinct(), "sequences")
    grammar = fit_grammar(sequences, rules)
    matrices = sequences.mapInArrow(
        _multiply(grammar.rounds), "symbols string, matrix array<struct<cost:bigint,audit:string>>"
    )
    matrices = scratch.keep(matrices, "matrices")
    parts = F.array_sort(F.collect_list(F.struct("chunk", "matrix")))
    joined = (
        chunks.join(matrices, "symbols")
        .groupBy("conv_id")
        .agg(
            F.transform(parts, lambda x: x["matrix"]).alias("parts"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum("turns").alias("turns"),
            *(F.sum(name).alias(name) for name in _COUNTS),
        )
        .withColumn("way", _ended(_follow(F.col("parts"))))
    )
    gaps = F.col("high").cast("long") - F.col("low").cast("long") + 1 - F.col("turns")
    return joined.select(
        "conv_id",
        F.coalesce(gaps, zero).alias("gaps"),
        *_COUNTS,
        F.col("way")["cost"].alias("cost"),
        F.col("way")["audit"].alias("audit"),
    )


class _Editor:
    """Follows an audit row by row; says which turns come out."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def _made(self) -> str:
        initial, role = _FITTING[self.state]
        self.state = _NEXT[self.state, initial]
        return role

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._made(), ""

    def edited(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._made(), text
        elif edit == "K":
            self.state = _NEXT[self.state, role[0]]
            yield role, text


def _events(batches: Iterator[pa.RecordBatch], head: Sequence[str]) -> Iterator[tuple[bool, list]]:
    """For rows sorted by conversation and place, each conversation's head first (place 0).

    Yields (True, the head's values), then (False, [role, text]) for each turn that comes out.
    """
    editor = None
    for batch in batches:
        names = ("at", "role", "text", "audit", *head)
        for at, role, text, audit, *values in zip(*(batch.column(n).to_pylist() for n in names)):
            if at == 0:
                if editor:
                    yield from ((False, list(turn)) for turn in editor.inserted())
                editor = _Editor(audit)
                yield True, values
            else:
                yield from ((False, list(turn)) for turn in editor.edited(role, text))
    if editor:
        yield from ((False, list(turn)) for turn in editor.inserted())


def _written(schema: T.StructType, rows: Iterator[list]) -> Iterator[pa.RecordBatch]:
    kinds = to_arrow_schema(schema)
    while part := list(itertools.islice(rows, BATCH)):
        columns = [pa.array(list(values), kind.type) for values, kind in zip(zip(*part), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=kinds.names)


def _digests(schema: T.StructType):
    head = schema.names[:-1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        values, digest, between = None, hashlib.sha256(), b""
        for is_head, event in _events(batches, head):
            if is_head:
                if values is not None:
                    yield [*values, digest.hexdigest()]
                values, digest, between = event, hashlib.sha256(), b""
            else:
                digest.update(between + ":".join(event).encode())
                between = b"\n"
        if values is not None:
            yield [*values, digest.hexdigest()]

    return lambda batches: _written(schema, rows(batches))


def _turns(schema: T.StructType):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        number = conversation = None
        for is_head, event in _events(batches, ["conv_id"]):
            if is_head:
                conversation, number = event[0], 0
            else:
                yield [conversation, number, *event]
                number += 1

    return lambda batches: _written(schema, rows(batches))


class Repair:
    """The cheapest way to bring conversations into the pattern: an optional system turn, then pairs of user and
    assistant; or no turn at all.

    ``rows``: conv_id, turn, role, text. Rows of a conversation are taken by turn, nulls first; rows with the same
    turn by role and text. A null role or text is one space. A role counts by its first letter; an empty role, like any
    other letter, fits nowhere. A row's first fault counts: blank (nothing but white space), duplicate (role and text as
    in an earlier row), truncated (the last character that is no white space isn't ``.``, ``!`` or ``?``).

    Keeping a row costs 0, another role 1, deleting 2, inserting an empty user or assistant turn 5. Blank and duplicate
    rows must go; a truncated row that stays costs 5 more. Of edits with the least cost those whose initials
    are the least in ASCII are taken.

    ``every`` names further conversations to report (conv_id): without rows, they need no edit. Rows without conv_id are
    one conversation. Empty tables give empty results; further columns are left out.
    """

    def __init__(
        self, rows: DataFrame, every: DataFrame | None = None, chunk: int = CHUNK, rules: int = RULES
    ) -> None:
        self.scratch = Scratch(rows.sparkSession, "repair")
        self.rows = self.scratch.keep(_judged(rows), "rows")
        every = self.rows if every is None else every.select("conv_id").union(self.rows.select("conv_id"))
        audits = _audited(self.rows, every, self.scratch, chunk, rules)
        #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
        self.audits = self.scratch.keep(audits, "audits")
        for label in ("chunks", "sequences", "matrices"):
            self.scratch.drop(label)

    def _stream(self) -> DataFrame:
        kinds = dict(self.audits.dtypes)
        body = self.rows.select(
            "conv_id",
            "at",
            "role",
            "text",
            *(F.lit(None).cast(kinds[c]).alias(c) for c in self.audits.columns[1:]),
        )
        nothing = F.lit(None).cast("string")
        heads = self.audits.select(
            "conv_id",
            F.lit(0).cast("long").alias("at"),
            nothing.alias("role"),
            nothing.alias("text"),
            *self.audits.columns[1:],
        )
        return heads.union(body).repartition("conv_id").sortWithinPartitions("conv_id", "at")

    def summary(self) -> DataFrame:
        """The audits, with the digest of each repaired conversation: ``role:text``, joined by line breaks."""
        schema = T.StructType([*self.audits.schema.fields, T.StructField("repaired_sha256", T.StringType())])
        return self._stream().mapInArrow(_digests(schema), schema)

    def turns(self) -> DataFrame:
        """The repaired conversations: conv_id, turn (from 0), role, text."""
        id_type = self.rows.schema["conv_id"]
        schema = T.StructType([id_type, *T.StructType.fromDDL("turn long, role string, text string").fields])
        return self._stream().mapInArrow(_turns(schema), schema)
