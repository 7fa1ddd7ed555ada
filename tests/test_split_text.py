"""Records cut out of split files, against plain parsers of whole files."""

import csv
import io
import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from visitrec.sources import read_csv, read_records
from visitrec.sources.split_text import CSV, JSON, Format, SplitText

FAILS = (PySparkException, Py4JJavaError, ValueError)


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


def broken_csv(seed, rows, header="k,a,b"):
    """Rows of a number and two cells with line breaks, quotes and commas in them."""
    pick = random.Random(seed)
    marks = ["x", "é", "\n", "\n\n", '"', '""', ",", ' "', "y z", "\r\n", "'"]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    table = []
    for i in range(rows):
        cells = ["c" + "".join(pick.choices(marks, k=pick.choice([0, 1, 3, 30]))) + "d" for _ in range(2)]
        table.append((str(i), *cells))
        writer.writerow(table[-1])
    return f"{header}\n{out.getvalue()}", table


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_broken_cells_in_many_splits(spark, tmp_path, small_splits, seed):
    text, table = broken_csv(seed, 800)
    path = put(tmp_path / "f.csv", text)
    df = read_csv(spark, path)
    assert sorted(tuple(r) for r in df.collect()) == sorted(table)
    assert len(text) > 20_000 and df.rdd.getNumPartitions() > 8


@pytest.mark.parametrize("chunk", [1, 300, 5000])
def test_chunks_of_any_size(spark, tmp_path, small_splits, chunk):
    text, table = broken_csv(9, 300)
    cut = SplitText(spark, put(tmp_path / "f.csv", text), CSV, chunk_bytes=chunk)
    records = [row.record for row in cut.records(skip_first=True).collect()]
    assert sorted(next(csv.reader(io.StringIO(r, newline="")))[0] for r in records) == sorted(r[0] for r in table)
    assert [row.record for row in cut.first_records().collect()] == [b"k,a,b"]


def test_a_cell_longer_than_many_splits(spark, tmp_path, small_splits):
    long = "line, with \"quotes\"\n" * 2000
    quoted = long.replace('"', '""')
    text = f'a,b\n1,"{quoted}"\n2,x\n3,"{quoted}"\n'
    rows = {r.a: r.b for r in read_csv(spark, put(tmp_path / "f.csv", text)).collect()}
    assert rows == {"1": long.strip(" \t"), "2": "x", "3": long.strip(" \t")}


def test_a_quote_inside_a_bare_cell_is_a_character(spark, tmp_path, small_splits):
    lines = [f'{i},5" pipe,{i}"' for i in range(500)]
    rows = read_csv(spark, put(tmp_path / "f.csv", "k,a,b\n" + "\n".join(lines))).collect()
    assert sorted(int(r.k) for r in rows) == list(range(500))
    assert {r.a for r in rows} == {'5" pipe'}


def test_many_files_and_odd_ends(spark, tmp_path, small_splits):
    put(tmp_path / "1.csv", '﻿k,a\r\n1,"x\r\ny"\r\n\r\n2,z')
    put(tmp_path / "2.csv", "k,a\n")
    put(tmp_path / "3.csv", "k,a")
    put(tmp_path / "4.csv", "\n\nk,a\n3,w\n \n")
    put(tmp_path / "5.csv", "")
    rows = read_csv(spark, str(tmp_path)).collect()
    assert sorted((r.k, r.a) for r in rows) == [("1", "x\r\ny"), ("2", "z"), ("3", "w")]
    assert read_csv(spark, str(tmp_path / "5.csv")).columns == []


def test_columns_go_by_name_in_each_file(spark, tmp_path, small_splits):
    one, table = broken_csv(4, 200)
    two, other = broken_csv(5, 150, header="a,k,c")
    put(tmp_path / "1.csv", one)
    put(tmp_path / "2.csv", two)
    put(tmp_path / "3.csv", "b,k\n" + "7,8\n" * 3)
    with pytest.raises(FAILS):
        read_csv(spark, str(tmp_path))
    df = read_csv(spark, str(tmp_path), by_name=True)
    expected = [(k, a, b, None) for k, a, b in table] + [(k, a, None, c) for a, k, c in other]
    expected += [("8", None, "7", None)] * 3
    got = [(r.k, r.a, r.b, r.c) for r in df.select("k", "a", "b", "c").collect()]
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_names_that_occur_twice(spark, tmp_path):
    df = read_csv(spark, put(tmp_path / "f.csv", 'a,A,,"b ""c"""\n1,2,3,4\n'))
    assert df.columns == ["a0", "A1", "_c2", 'b "c"'] and tuple(df.first()) == ("1", "2", "3", "4")


def invented_objects(seed, n):
    pick = random.Random(seed)
    marks = ["x", "{", "}", '"', "\\", "[", "]", ",", "\n", "é", '\\"', "{}", "}{"]
    return [
        {"k": str(i), "a": "".join(pick.choices(marks, k=pick.choice([0, 2, 9, 60]))), "deep": {"b": [{"c": "}"}]}}
        for i in range(n)
    ]


class _Unused:
    def __getattr__(self, name):
        raise AssertionError("quotes are looked for one by one")


def test_quotes_of_a_chunk_are_found_at_once():
    """A pattern's step for each quoted stretch, in either case and in three passes, took most of the time."""
    at_once = Format(JSON.separator, _Unused(), _Unused(), nested=True)
    objects = invented_objects(3, 50) + [{"k": "\\", "a": '\\"{'}, {"k": "", "a": "{"}]
    texts = [o | {"k": i} for i, o in enumerate(objects)]
    text = ",".join(json.dumps(o, ensure_ascii=False) for o in texts).encode()
    assert at_once.after(text, False) == (False, 0)
    head, records, tail = at_once.cut(text, (False, 0))
    assert [json.loads(r) for r in records] == texts and head is None and tail is None
    for cut in range(0, len(text), 7):
        inside, depth = JSON.after(text[:cut], False)
        head, records, tail = JSON.cut(text[:cut], (False, 0))
        more, others, last = JSON.cut(text[cut:], (inside, depth)) if b"\\" not in text[cut - 1 : cut] else (0, 0, 0)
        if others != 0:
            joined = [(tail or b"") + more] if more is not None else []
            assert [json.loads(r) for r in records + joined + others] == texts and last is None


def _by_pattern(text, inside):
    spans, at = [], 0
    if inside:
        match = JSON.quoted_rest.match(text)
        spans.append(match.span())
        inside, at = not match[1], match.end()
    if not inside:
        for match in JSON.quoted.finditer(text, at):
            spans.append(match.span())
            inside = not match[1]
    return spans, inside


@pytest.mark.parametrize("inside", [False, True])
def test_quotes_are_those_of_the_pattern(inside):
    pick = random.Random(6)
    for _ in range(5000):
        text = "".join(pick.choices('""\\{}x,', k=pick.randrange(14))).encode()
        spans, ends_inside = JSON.quotes(text, inside)
        expected, expected_inside = _by_pattern(text, inside)
        # a backslash at the very end may be in or out of the last stretch
        if ends_inside and expected_inside and text.endswith(b"\\"):
            spans[-1, 1], expected[-1] = len(text), (expected[-1][0], len(text))
        assert (spans.tolist(), ends_inside) == ([list(s) for s in expected], expected_inside), text


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_one_array_makes_many_tasks(spark, tmp_path, small_splits, seed, indent):
    objects = invented_objects(seed, 500)
    path = put(tmp_path / "a.json", json.dumps(objects, indent=indent, ensure_ascii=False))
    cut = SplitText(spark, path, JSON)
    assert cut.stored.select("start").distinct().count() > 8
    assert sorted((r["k"], r["a"]) for r in (json.loads(x.record) for x in cut.records().collect())) == sorted(
        (o["k"], o["a"]) for o in objects
    )
    df = read_records(spark, path, ["k", "a"])
    assert sorted((r.k, r.a or "") for r in df.collect()) == sorted((o["k"], o["a"]) for o in objects)


@pytest.mark.parametrize("chunk", [1, 100, 3000])
def test_objects_over_chunks(spark, tmp_path, small_splits, chunk):
    objects = invented_objects(7, 120)
    path = put(tmp_path / "a.json", json.dumps(objects))
    found = [json.loads(r.record) for r in SplitText(spark, path, JSON, chunk_bytes=chunk).records().collect()]
    assert sorted(found, key=lambda o: o["k"]) == sorted(objects, key=lambda o: o["k"])


@pytest.mark.parametrize(
    "body",
    ['[{"k": "1"}', '[{"k": "1"}, {"k": ', '[{"k": "1"} x {"k": "2"}]', '[{"k": "1"}}]', '["k"]', '[{"k": "1]'],
)
def test_malformed_arrays_stop_the_job(spark, tmp_path, body):
    with pytest.raises(FAILS):
        read_records(spark, put(tmp_path / "a.json", body), ["k"]).collect()


def test_absent_fields_can_be_reported(spark, tmp_path):
    path = put(tmp_path / "a.json", '[{"k": "1"}, {"k": "2", "a": null}]')
    with pytest.warns(UserWarning, match="no record holds: a$"):
        df = read_records(spark, path, ["k", "a"], absent="warn")
    assert sorted(tuple(r) for r in df.collect()) == [("1", None), ("2", None)]


def test_files_are_read_once(spark, tmp_path):
    """What comes back stands in the shared folder; the files may go."""
    shared = spark.conf.get("spark.checkpoint.dir")
    text, table = broken_csv(1, 50)
    frames = [
        read_csv(spark, put(tmp_path / "f.csv", text)),
        read_records(spark, put(tmp_path / "a.json", json.dumps(invented_objects(1, 50))), ["k"]),
        read_records(spark, put(tmp_path / "l.json", '{"k": "1"}\n' * 50), ["k"], one_array_per_file=False),
    ]
    for df in frames:
        assert all(shared in path for path in df.inputFiles())
    for path in tmp_path.iterdir():
        if path.is_file():
            path.write_text("")
    assert [df.count() for df in frames] == [50, 50, 50]
