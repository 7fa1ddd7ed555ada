"""Conversation repair against a plain version that keeps every best way, odd rows included."""

import hashlib
import itertools
import random

import pytest

from visitrec.llm.repair import (
    SYMBOLS,
    Grammar,
    Repair,
    Rope,
    better,
    choose_pairs,
    fit_grammar,
    identity,
    symbol_matrix,
    times,
)

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLES = (("u", "user"), ("a", "assistant"))
SCHEMA = "conv_id long, turn long, role string, text string, at int, `a.b` string"


def with_insertions(ways):
    for _ in range(3):
        for state, (cost, audit, lines) in list(ways.items()):
            for initial, role in ROLES:
                if (state, initial) in NEXT:
                    way = (cost + 5, audit + "I", (*lines, f"{role}:"))
                    after = NEXT[state, initial]
                    if after not in ways or way[:2] < ways[after][:2]:
                        ways[after] = way
    return ways


def plain(rows):
    """One conversation's (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
    seen, faults, ways = set(), [], {0: (0, "", ())}
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else ""
        fault = fault or ("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
        faults.append(fault)
        after = {}
        for state, (cost, audit, lines) in with_insertions(ways).items():
            edits = [(state, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                cost += 5 if fault else 0
                if (state, role[:1]) in NEXT:
                    edits.append((NEXT[state, role[:1]], (cost, audit + "K", (*lines, f"{role}:{text}"))))
                for initial, other in ROLES:
                    if (state, initial) in NEXT:
                        edits.append((NEXT[state, initial], (cost + 1, audit + "R", (*lines, f"{other}:{text}"))))
            for to, way in edits:
                if to not in after or way[:2] < after[to][:2]:
                    after[to] = way
        ways = after
    ways = with_insertions(ways)
    cost, audit, lines = min((ways[s] for s in (0, 3) if s in ways), key=lambda way: way[:2])
    turns = [row[0] for row in rows if row[0] is not None]
    initials = [row[1][:1] for row in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, v) for v in row))


def check(spark, conversations, **options):
    rows = [(c, t, r, x, 1, "z") for c, turns in conversations.items() for t, r, x in turns]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    every = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    repair = Repair(frame, every, **options)
    expected = ordered((c, *plain(turns)) for c, turns in conversations.items())
    assert ordered(tuple(r) for r in repair.summary().collect()) == expected
    return repair


def invented(seed, n, longest):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "user", "assistant", "s", "", None]
    texts = ["Hello.", "so long", "", "Really?", " \t", "Yes!", "no end ", "Done. ", None, "Ünd."]
    out = {}
    for c in range(n):
        length = pick.randint(0, longest)
        out[c] = [
            (pick.choice([i, i, i, i + 2, None]), pick.choice(roles), pick.choice(texts) if pick.random() < 0.6 else f"{i}.")
            for i in range(length)
        ]
    return out


@pytest.mark.parametrize("options", [{}, {"chunk": 3}, {"chunk": 8, "rules": 5}, {"rules": 0}])
def test_many_small_conversations(spark, options):
    check(spark, invented(3, 300, 9), **options)


def test_long_conversations(spark):
    check(spark, invented(4, 12, 400), chunk=64)


def test_odd_rows(spark):
    check(
        spark,
        {
            None: [(0, "user", "Hi."), (1, "assistant", "Ho.")],
            1: [],
            2: [(None, None, None), (None, None, None)],
            3: [(0, "user", "x " * 200_000 + "."), (5, "assistant", "y" * 300_000)],
            4: [(1, "user", "a."), (1, "user", "a."), (1, "assistant", "b."), (1, "assistant", "a.")],
            5: [(-3, "system", "s.")],
            6: [(0, "", "a."), (1, "assistant", "b.")],
            7: [(0, "User", "a."), (1, "ASSISTANT", "b.")],
        },
    )


def test_empty(spark):
    assert Repair(spark.createDataFrame([], SCHEMA)).summary().collect() == []
    assert Repair(spark.createDataFrame([], SCHEMA)).turns().collect() == []


def test_turns_follow_the_pattern(spark):
    repair = check(spark, invented(5, 200, 7))
    initials = {}
    for row in sorted(repair.turns().collect(), key=lambda r: (r.conv_id, r.turn)):
        initials[row.conv_id] = initials.get(row.conv_id, "") + row.role[0]
    import re

    assert initials and all(re.fullmatch("s?(ua)+", text) for text in initials.values())


def test_copies_of_a_conversation_share_their_matrix(spark):
    turns = [(0, "user", "a."), (1, "user", "b."), (2, "assistant", "c")]
    repair = check(spark, {c: turns for c in range(500)})
    assert repair.audits.select("audit").distinct().count() == 1


def test_ropes_compare_as_texts():
    pick = random.Random(7)
    ropes = [Rope(t) for t in ("", "D", "K", "R", "KD", "DK", "I")]
    for _ in range(300):
        ropes.append(pick.choice(ropes) + pick.choice(ropes[-40:]))
    for _ in range(4000):
        a, b = pick.choice(ropes), pick.choice(ropes)
        if a.size < 3000 and b.size < 3000:
            assert (a < b) == (str(a) < str(b))


def flat(matrix):
    return [[cell and (cell[0], str(cell[1])) for cell in row] for row in matrix]


def test_matrices_are_associative_with_ties():
    symbols = [symbol_matrix(s) for s in SYMBOLS]
    pick = random.Random(2)
    for _ in range(150):
        a, b, c = (pick.choice(symbols) for _ in range(3))
        assert flat(times(times(a, b), c)) == flat(times(a, times(b, c)))
    assert flat(times(identity(), symbols[0])) == flat(symbols[0])
    assert better(None, None) is None


def test_grammar_gives_back_the_symbols(spark):
    pick = random.Random(9)
    texts = ["".join(pick.choices(SYMBOLS, [3, 9, 9, 1, 1, 1, 1, 1, 2], k=pick.randint(0, 60))) for _ in range(200)]
    texts += ["u" * n for n in range(10)] + ["ua" * 50] * 2
    grammar = fit_grammar(spark.createDataFrame([(t,) for t in texts], "symbols string").repartition(3))
    assert len(grammar.rules) > 20
    spelled = list(SYMBOLS)
    for left, right in grammar.rules:
        spelled.append(spelled[left] + spelled[right])
    symbols, owner = grammar.compressed(texts)
    out = [""] * len(texts)
    for symbol, at in zip(symbols.tolist(), owner.tolist()):
        out[at] += spelled[symbol]
    assert out == texts and len(symbols) < sum(map(len, texts)) / 2


def test_chosen_pairs_cannot_overlap():
    pick = random.Random(3)
    for _ in range(100):
        pairs = list(itertools.product(range(6), repeat=2))
        pick.shuffle(pairs)
        chosen = choose_pairs(pairs)
        assert all(a[1] != b[0] for a in chosen for b in chosen if a != b)
