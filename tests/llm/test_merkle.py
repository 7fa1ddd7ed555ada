"""The Merkle manifest against a plain version, odd rows included."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from visitrec.llm.merkle import prove

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree long, `a.b` int"


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(leaves, fanout):
    """The root, and for each leaf its siblings left and right, level by level."""
    paths, places, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, place in enumerate(places):
            start = place - place % fanout
            paths[i].append((level[start:place], level[place + 1 : start + fanout]))
            places[i] = place // fanout
        level = [digest(level[i : i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], paths


def plain(rows, lowered, fanout=8):
    rows = [(*r, leaf(r), leaf((*r[:4], lowered(r[0], r[4])))) for r in (row[:5] for row in rows)]
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    parts = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, r[5]))
        parts.append((own, *tree([r[5] for r in own], fanout)))
    if not parts:
        return []
    root, tops = tree([part[1] for part in parts], fanout)
    out = []
    for (own, subroot, paths), top in zip(parts, tops):
        for row, path in zip(own, paths):
            folded = row[6]
            for left, right in path + top:
                folded = digest([*left, folded, *right])
            proof = digest(x for left, right in path + top for x in left + right)
            out.append((row[0], row[5], subroot, root, proof, folded, folded == root))
    return out


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(number, text):
    touched = number is not None and text is not None and zlib.crc32(str(number).encode()) % 3 == 0
    return text.translate(str.maketrans(UPPER, UPPER.lower())) if touched else text


def altered():
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return {"text": F.when(touched, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))}


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def check(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 7, 1) for r in rows], SCHEMA).repartition(5)
    result = prove(frame, altered=altered(), **options)
    expected = ordered(plain(rows, lowered, options.get("fanout", 8)))
    assert ordered(result.collect()) == expected
    return result


def many(langs, n=700):
    return [(i, f"s{i % 3}", langs[i % len(langs)], i * 7, f"Text É {i}" * (i % 5)) for i in range(n)]


@pytest.mark.parametrize("block_levels", [1, 2, 4])
def test_trees_of_uneven_size(spark, block_levels):
    check(spark, many(["en"] * 5 + [None, "de", "é"]), block_levels=block_levels)


def test_more_trees_than_a_run_holds(spark):
    check(spark, many([f"l{i}" for i in range(75)] + ["en"] * 60), block_levels=1)


def test_other_fanout(spark):
    check(spark, many(["en", "de", "fr"], 130), fanout=3, block_levels=1)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 513])
def test_one_tree(spark, n):
    check(spark, many(["en"], n), block_levels=1)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None),
        (1, None, "en", 0, ""),
        (1, None, "en", 0, ""),
        (1, "s", "en", 3, "ABC"),
        (2, "s", "", 2, "Éß\x00"),
        (None, "s", "en", -5, "X"),
        (3, "-", "-", 1, "LONG " * 300_000),
    ]
    check(spark, rows)


def test_empty(spark):
    assert check(spark, []).columns[0] == "doc_id"


def test_tampering_is_seen(spark):
    rows = many(["en", "de"], 60)
    result = {r.doc_id: r.verified for r in check(spark, rows).collect()}
    assert result == {r[0]: lowered(r[0], r[4]) == r[4] for r in rows}
