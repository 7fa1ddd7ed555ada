"""Column expressions, one case per trap."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from visitrec.functions import (
    blank_to_null,
    clean_cell,
    date_from_parts,
    date_in_zone,
    default_run_date,
    first_ticked,
    is_code,
    is_not_code,
    iso_date,
    matches,
    run_date_text,
    to_integer,
    whole_number,
)


def apply(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    rows = df.select("i", make(F.col("c")).alias("out")).orderBy("i").collect()
    return [row.out for row in rows]


def test_blank_to_null(spark):
    assert apply(spark, ["", " ", "a", None], blank_to_null) == [None, " ", "a", None]


def test_clean_cell(spark):
    cells = [" a ", "\tb", "", "  ", "NA", " NA ", "NAN", "a b", None]
    assert apply(spark, cells, clean_cell) == ["a", "b", None, None, None, None, "NAN", "a b", None]


def test_to_integer(spark):
    texts = ["2", "2.7", "-2.7", " 2 ", "2e0", "2.", ".9", "", "x", "2d", "2f", "1 2", "3000000000", "NaN", None]
    expected = [2, 2, -2, 2, 2, 2, 0, None, None, None, None, None, None, None, None]
    assert apply(spark, texts, to_integer) == expected


def test_whole_number(spark):
    assert apply(spark, ["3", "03", "2.7", "x", "", None], whole_number) == [3, 3, None, None, None, None]


def test_iso_date(spark):
    texts = ["2019-03-05", "2020-02-29", "2020-02-30", "2020", "2020-01", "2020-1-1 x", "2020-01-1T", "bad", "", None]
    expected = [dt.date(2019, 3, 5), dt.date(2020, 2, 29)] + [None] * 8
    assert apply(spark, texts, iso_date) == expected


@pytest.mark.parametrize("kind", ["int", "string"])
def test_date_from_parts(spark, kind):
    parts = [
        (3, 5, 2019), (2, 29, 2020), (2, 30, 2020), (2, 29, 2019), (13, 1, 2019), (0, 1, 2019),
        (1, 0, 2019), (4, 31, 2019), (12, 31, 2019), (1, 1, 19), (1, 1, 20190), (1, 1, -2019),
        (None, 5, 2019), (1, None, 2019), (1, 5, None),
    ]
    expected = {0: dt.date(2019, 3, 5), 1: dt.date(2020, 2, 29), 8: dt.date(2019, 12, 31), 9: dt.date(2019, 1, 1)}
    rows = [(i, *[None if p is None else (str(p) if kind == "string" else p) for p in part]) for i, part in enumerate(parts)]
    df = spark.createDataFrame(rows, f"i int, m {kind}, d {kind}, y {kind}")
    out = df.select("i", date_from_parts(F.col("m"), F.col("d"), F.col("y")).alias("o")).orderBy("i").collect()
    assert [row.o for row in out] == [expected.get(i) for i in range(len(parts))]


def test_date_from_bad_text_parts(spark):
    df = spark.createDataFrame([("x", "5", "2019"), ("1.5", "5", "2019")], "m string, d string, y string")
    out = df.select(date_from_parts(F.col("m"), F.col("d"), F.col("y")).alias("o")).collect()
    assert [row.o for row in out] == [None, None]


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_date_in_zone_ignores_the_session_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        point = F.timestamp_seconds(F.lit(1561955400))  # 2019-07-01 04:30 UTC
        assert spark.range(1).select(date_in_zone(point).alias("d")).first().d == dt.date(2019, 6, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_run_date():
    assert run_date_text("2024-03-01") == run_date_text(dt.date(2024, 3, 1)) == "2024-03-01"
    assert run_date_text() == default_run_date().isoformat()
    with pytest.raises(ValueError):
        run_date_text("today")


def test_codes_are_text(spark):
    values = ["2", "02", "x", "2.0", "", None]
    assert apply(spark, values, lambda c: is_code(c, 2)) == [True, False, False, False, False, None]
    assert apply(spark, values, lambda c: is_not_code(c, 2)) == [False, True, True, True, True, None]
    assert apply(spark, [2, 1, None], lambda c: is_code(c, 2), "int") == [True, False, None]


def test_patterns(spark):
    versions = ["3", "3.", "3.0", "3.2", "30", "32", "3.3", "33", "2", "13", None]
    expected = [True] * 6 + [False] * 4 + [None]
    assert apply(spark, versions, lambda c: matches(c, r"^3\.?[012]?$")) == expected
    ids = ["UM00000001", "UM0000001", "UM00000001--1", "xUM00000001"]
    assert apply(spark, ids, lambda c: matches(c, r"^UM\d{8}$")) == [True, False, False, False]
    events = ["visit_1_arm_1", "visit_12_arm_1", "xvisit_12_arm_10", "visit_123_arm_1", "misc_arm_1"]
    found = [True, True, True, False, False]
    assert apply(spark, events, lambda c: matches(c, r"visit_\d{1,2}_arm_1")) == found


def test_first_ticked(spark):
    rows = [
        ("1", "0", "0", "0", 1), ("0", "1", "1", "0", 2), (None, "0", "0", "1", 9), ("0", "0", "1", "1", 3),
        ("0", "0", "0", "0", None), (None, None, None, None, None), ("01", "0", "0", "0", None),
    ]
    df = spark.createDataFrame(rows, "k___1 string, k___2 string, k___3 string, k___9 string, want int")
    out = df.select("want", first_ticked("k").alias("got"))
    assert out.schema["got"].dataType.simpleString() == "int"
    assert [row.got for row in out.collect()] == [row[-1] for row in rows]
