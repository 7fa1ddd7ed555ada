"""Readers, writers and the daily run, on files."""

import datetime as dt
import glob
import json
import os
import warnings

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from visitrec.operators import blanks_to_null, integers_by_suffix, keys_first
from visitrec.plans import (
    FVP,
    IVP,
    PACKETS,
    export_text,
    run_day,
    run_packet,
    run_reconcile,
)
from visitrec.storage import Scratch
from visitrec.plans.rules import IDENTIFIERS, VISIT_FIELDS
from visitrec.sinks import push_folder, text_records, write_csv, write_csv_if_any, write_text_records
from visitrec.sources.csv_files import breaks_in_quotes
from visitrec.sources.landing import literal_path
from visitrec.sources import (
    freshness,
    landing_files,
    newest_file,
    read_csv,
    read_push_list,
    read_records,
    read_registry,
    records_from_text,
)

from test_packets import LOCAL, REGISTRY, listed, pull

DAY = "2024-03-02"
JOB_FAILS = (PySparkException, Py4JJavaError)


def put(path, text, when=None):
    path.write_text(text)
    if when is not None:
        os.utime(path, (when, when))
    return str(path)


def at(day, hour=12):
    moment = dt.datetime.fromisoformat(f"{day}T{hour:02}:00:00+00:00")
    return moment.timestamp()


def lines(folder):
    parts = sorted(glob.glob(f"{folder}/part-*"))
    return [line for part in parts for line in open(part).read().splitlines()]


def test_csv_dialect(spark, tmp_path):
    text = 'a,b,c\n 1 ,NA,"x ""q"" y"\n,"","two\nlines"\n"NA", "p,q" ,\tz\n'
    df = read_csv(spark, put(tmp_path / "f.csv", text))
    assert [tuple(row) for row in df.collect()] == [
        ("1", None, 'x "q" y'),
        (None, None, "two\nlines"),
        (None, "p,q", "z"),
    ]


def test_only_broken_cells_keep_a_file_whole(spark, tmp_path):
    broken = put(tmp_path / "1.csv", 'a,b\n1,"x\ny"\n')
    plain = put(tmp_path / "2.csv", 'a,b\n1,"say ""x"""\n2,"""\n')
    quoted = put(tmp_path / "3.csv", 'a,b\n1,"say ""x"""\n')
    assert breaks_in_quotes(spark, broken)
    assert breaks_in_quotes(spark, plain)
    assert not breaks_in_quotes(spark, quoted)
    assert breaks_in_quotes(spark, [quoted, broken])
    rows = [("1", 'say "x"')]
    for multi_line in (None, True, False):
        assert [tuple(r) for r in read_csv(spark, quoted, multi_line).collect()] == rows


def test_large_plain_file_is_split(spark, tmp_path):
    path = put(tmp_path / "big.csv", "a,b\n" + "".join(f'{i},"t ""{i}"""\n' for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50KB")
        df = read_csv(spark, path)
        assert df.rdd.getNumPartitions() > 3
        assert df.count() == 20000
        assert df.filter("a = '19999'").first().b == 't "19999"'
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_columns_go_by_name(spark, tmp_path):
    put(tmp_path / "r.csv", "FORMVER,VISITDAY,PTID,VISITYR,VISITNUM,VISITMO,EXTRA\n3.0,x,UM00000001,2019,001,3,e\n")
    df = read_registry(spark, str(tmp_path / "r.csv"))
    row = df.first()
    assert (row.PTID, row.VISITMO, row.VISITDAY, row.VISITYR) == ("UM00000001", 3, None, 2019)
    assert (row.VISITNUM, row.FORMVER, row.EXTRA) == ("001", "3.0", "e")


def test_odd_headers(spark, tmp_path):
    text = "\ufeffa.b,c d,`e`,F_Complete\n 1,NA,,2.7\n"
    for name, body in (("plain.csv", text), ("broken.csv", text + '2,"x\ny",,2\n')):
        df = read_csv(spark, put(tmp_path / name, body))
        assert df.columns == ["a.b", "c d", "`e`", "F_Complete"]
        assert tuple(df.first()) == ("1", None, None, "2.7")
        assert tuple(keys_first(integers_by_suffix(blanks_to_null(df)), ["c d"]).first()) == (None, "1", None, 2)


def test_csv_with_another_header_stops_the_job(spark, tmp_path):
    put(tmp_path / "1.csv", "a,b\n1,2\n")
    put(tmp_path / "2.csv", "b,a\n1,2\n")
    with pytest.raises(JOB_FAILS):
        read_csv(spark, str(tmp_path)).collect()


def test_registry_without_a_date_column_stops_the_job(spark, tmp_path):
    with pytest.raises(ValueError, match="VISITYR"):
        read_registry(spark, put(tmp_path / "r.csv", "PTID,VISITMO,VISITDAY\nUM00000001,1,1\n"))


def test_csv_output(spark, tmp_path):
    rows = [("a ", 'say "hi"', 2, dt.date(2020, 1, 2)), (None, "p,q", None, None), (" b", "two\nlines", 1, None)]
    df = spark.createDataFrame(rows, "k string, t string, n int, d date").coalesce(1)
    path = write_csv(df, str(tmp_path / "out.csv"))
    assert "\n".join(lines(path)) == 'k,t,n,d\na ,"say ""hi""",2,2020-01-02\n,"p,q",,\n b,"two\nlines",1,'
    back = read_push_list(spark, path)
    assert [row.t for row in back.collect()] == ['say "hi"', "p,q", "two\nlines"]
    write_csv(df.limit(1), path)
    assert read_push_list(spark, path).count() == 1


def test_empty_output_has_a_header(spark, tmp_path):
    empty = spark.createDataFrame([], "ptid string, visitnum string")
    path = write_csv(empty, str(tmp_path / "empty.csv"))
    assert lines(path) == ["ptid,visitnum"]
    assert read_push_list(spark, path).columns == ["ptid", "visitnum"]
    assert read_push_list(spark, path).count() == 0


def test_write_only_if_any(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "k string").coalesce(1)
    assert write_csv_if_any(df.limit(0), str(tmp_path / "none")) is None
    assert not (tmp_path / "none").exists()
    assert lines(write_csv_if_any(df, str(tmp_path / "some"))) == ["k", "a"]


def test_records(spark, tmp_path):
    objects = [{"visitnum": "001", "ptid": "p", "other": "x"}, {"ptid": "q", "visitnum": ""}]
    path = put(tmp_path / "a.json", json.dumps(objects, indent=1))
    df = read_records(spark, path, ["ptid", "visitnum"])
    assert df.columns == ["ptid", "visitnum"]
    assert [tuple(row) for row in df.collect()] == [("p", "001"), ("q", None)]
    flat = put(tmp_path / "b.json", "\n".join(json.dumps(o) for o in objects))
    again = read_records(spark, flat, ["ptid", "visitnum"], one_array_per_file=False)
    assert again.collect() == df.collect()
    text = spark.createDataFrame([(json.dumps(objects),), ("[]",), (None,)], "t string")
    assert records_from_text(text, "t", ["ptid", "visitnum"]).collect() == df.collect()


def test_fields_that_no_record_holds_stop_the_job(spark, tmp_path):
    fields = ["ptid", "status"]
    late = put(tmp_path / "late.json", json.dumps([{"ptid": "p"}, {"ptid": "q", "status": ""}]))
    assert read_records(spark, late, fields).count() == 2
    blank = put(tmp_path / "blank.json", json.dumps([{"ptid": "p", "status": ""}]))
    assert read_records(spark, blank, fields).first().status is None
    for body, absent in (([{"ptid": "p", "state": "2"}], "status"), ({"error": "no"}, "ptid, status")):
        path = put(tmp_path / "a.json", json.dumps(body))
        with pytest.raises(ValueError, match=f"no record holds: {absent}$"):
            read_records(spark, path, fields)
    text = spark.createDataFrame([('[{"ptid": "p"}]',), ('[{"ptid": "q"}]',)], "t string")
    with pytest.raises(ValueError, match="no record holds: status"):
        records_from_text(text, "t", fields)
    assert read_records(spark, put(tmp_path / "none.json", "[]"), fields).count() == 0


def test_landing_takes_names_as_they_are(spark, tmp_path):
    folder = tmp_path / "in[1]{a}"
    (folder / "a=1").mkdir(parents=True)
    put(folder / "a=1" / "new.csv", "x", at("2024-03-09"))
    put(folder / "x[1]*?.csv", "k\nv\n", at("2024-03-01"))
    put(folder / "x1.csv", "k\nw\n", at("2024-02-01"))
    files = landing_files(spark, f"{folder}/")
    assert sorted(os.path.basename(row.path) for row in files.collect()) == ["x1.csv", "x[1]*?.csv"]
    assert [r.k for r in read_csv(spark, literal_path(newest_file(files).first().path)).collect()] == ["v"]


def test_malformed_records_stop_the_job(spark, tmp_path):
    path = put(tmp_path / "a.json", '[{"ptid": "p"}, {"ptid": ]')
    with pytest.raises(JOB_FAILS):
        read_records(spark, path, ["ptid"]).collect()
    text = spark.createDataFrame([('[{"ptid": ',)], "t string")
    with pytest.raises(JOB_FAILS):
        records_from_text(text, "t", ["ptid"]).collect()


def test_landing_folder(spark, tmp_path):
    put(tmp_path / "b.csv", "x", at("2024-03-01"))
    put(tmp_path / "a.csv", "x", at("2024-03-01"))
    put(tmp_path / "c.csv", "x", at("2024-02-28"))
    (tmp_path / "sub").mkdir()
    put(tmp_path / "sub" / "d.csv", "x", at("2024-03-09"))
    files = landing_files(spark, str(tmp_path))
    assert sorted(os.path.basename(row.path) for row in files.collect()) == ["a.csv", "b.csv", "c.csv"]
    latest = newest_file(files)
    assert latest.first().path.endswith("/a.csv")
    row = freshness(latest, "2024-03-01").first()
    assert (row.file_date, row.run_date, row.is_stale) == (dt.date(2024, 3, 1),) * 2 + (False,)
    assert freshness(latest, "2024-03-02").first().is_stale
    put(tmp_path / "e.csv", "x", at("2024-03-02", hour=4))
    assert freshness(newest_file(landing_files(spark, str(tmp_path))), "2024-03-01").first().is_stale is False


def test_text_records(spark, tmp_path):
    df = spark.createDataFrame([("ab", 1), (None, 23)], "k string, n int")
    layout = [("n", 3, "0"), ("k", 4, ".")]
    assert [row.value for row in text_records(df, layout).collect()] == ["100ab..", "230...."]
    assert sorted(lines(write_text_records(df, layout, str(tmp_path / "t.txt")))) == ["100ab..", "230...."]
    with pytest.raises(JOB_FAILS, match="wider than 1"):
        text_records(df, [("k", 1, " ")]).collect()
    with pytest.raises(ValueError):
        text_records(df, [("zz", 1, " ")])


def test_push_folder():
    assert push_folder("/x/", DAY) == push_folder("/x", dt.date(2024, 3, 2)) == "/x/push_2024-03-02"
    with pytest.raises(ValueError):
        push_folder("/x", "../..")


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    scratch = Scratch(spark, "test")
    kept = scratch.keep(spark.range(3), "numbers")
    assert kept.count() == 3
    assert kept.inputFiles()[0].removeprefix("file://").startswith(shared)
    scratch.drop()
    assert not os.path.exists(scratch.root)


def test_line_break_in_a_text_record(spark):
    df = spark.createDataFrame([("a\nb",)], "a string")
    with pytest.raises(Exception, match="line break in column a"):
        text_records(df, [("a", 9, " ")]).collect()


@pytest.fixture
def local_visits(spark):
    return blanks_to_null(spark.createDataFrame(LOCAL, ", ".join(f"{c} string" for c in VISIT_FIELDS)))


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    header = "PTID,VISITMO,VISITDAY,VISITYR,VISITNUM,FORMVER"
    body = "\n".join(",".join(cell or "" for cell in row) for row in REGISTRY)
    put(folder / "new.csv", f"{header}\n{body}\n", at(DAY))
    put(folder / "old.csv", f"{header}\n", at("2024-03-01"))
    return str(folder)


def test_reconcile_run(spark, tmp_path, local_visits, landing):
    with pytest.warns(UserWarning, match="the local side lacks"):
        out = run_reconcile(spark, landing, local_visits, str(tmp_path), DAY)
    assert not out.stale_input
    assert out.push_list == f"{tmp_path}/push_{DAY}/df_redcap_yes_nacc_no_{DAY}.csv"
    assert out.registry_only == f"{tmp_path}/push_{DAY}/df_redcap_no_nacc_yes_{DAY}.csv"
    pushed = read_push_list(spark, out.push_list)
    assert sorted(int(row.ptid[2:]) for row in pushed.collect()) == [9, 14, 15, 16, 17, 18, 19, 19]
    assert pushed.filter("ptid = 'UM00000018'").first().fvp_z1_complete == "2"
    assert pushed.filter("ptid = 'UM00000009'").first().visitnum == "001"
    alone = read_push_list(spark, out.registry_only)
    assert alone.columns == ["ptid", "form_date", "visitnum"]
    assert sorted(int(row.ptid[2:]) for row in alone.collect()) == [1, 2, 3, 6, 7]


def test_reconcile_run_without_discrepancy_on_stale_input(spark, tmp_path, local_visits):
    folder = tmp_path / "landing"
    folder.mkdir()
    put(folder / "a.csv", "PTID,VISITMO,VISITDAY,VISITYR,VISITNUM,FORMVER\n", at("2024-03-01"))
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        out = run_reconcile(spark, str(folder), local_visits, str(tmp_path), DAY)
    assert out.stale_input and out.registry_only is None
    messages = [str(w.message) for w in caught if "registry" in str(w.message)]
    assert len(messages) == 1 and "2024-03-01" in messages[0]
    assert read_push_list(spark, out.push_list).count() == 10


def test_reconcile_run_needs_a_file(spark, tmp_path, local_visits):
    (tmp_path / "landing").mkdir()
    with pytest.raises(FileNotFoundError):
        run_reconcile(spark, str(tmp_path / "landing"), local_visits, str(tmp_path), DAY)


def every_form(rule):
    dictionary = {form: [] for form in rule.pulled}
    dictionary["header"] = [*IDENTIFIERS, "answer"]
    dictionary[rule.pulled[-2]] = list(rule.checkbox_groups)
    return dictionary


def all_packets(spark):
    """One record per packet in one wide table, as the form data is kept."""
    parts = []
    for rule, ptid in zip(PACKETS[:3], ("UM00000009", "UM00000014", "UM00000014")):
        parts.append(pull(spark, rule, [(ptid, {"tvp_c2t_complete": "0"} if rule.excluded else {})]))
    wide = parts[0]
    for part in parts[1:]:
        wide = wide.unionByName(part, allowMissingColumns=True)
    return wide.withColumns({f"{p}_z1_complete": F.lit("2") for p in ("ivp", "fvp", "tvp")})


def test_day(spark, tmp_path, local_visits, landing):
    dictionary = {}
    for rule in PACKETS:
        dictionary.update({form: fields for form, fields in every_form(rule).items() if fields or form not in dictionary})
    with pytest.warns(UserWarning):
        _, packets = run_day(
            spark, landing, local_visits, all_packets(spark), dictionary, str(tmp_path), DAY,
            exports={"ivp": ({"ptid": "ID"}, [("ID", 12, " ")])},
        )
    csv, text = packets["ivp"].exported
    assert read_push_list(spark, csv).first()["ID"] == "UM00000009" and lines(text) == ["UM00000009  "]
    assert packets["fvp"].exported is None
    ready ={name: [r.ptid for r in read_push_list(spark, out.ready).collect()] for name, out in packets.items()}
    assert ready == {"ivp": ["UM00000009"], "fvp": ["UM00000014"], "tvp": ["UM00000014"], "tvpc2": []}
    blocked = {name: read_push_list(spark, out.blocked).count() for name, out in packets.items()}
    assert blocked == {"ivp": 0, "fvp": 0, "tvp": 0, "tvpc2": 1}
    names = {os.path.basename(p) for p in glob.glob(f"{tmp_path}/push_{DAY}/*.csv")}
    assert names - {os.path.basename(csv)} == {
        f"df_redcap_yes_nacc_no_{DAY}.csv", f"df_redcap_no_nacc_yes_{DAY}.csv",
        *[f"{mark}NACC_UDS3_{p}_{DAY}.csv" for mark in ("", "BLOCKED_") for p in ("ivp", "fvp", "tvp", "tvpc2")],
    }


def test_packet_with_nothing_routed(spark, tmp_path):
    records = pull(spark, IVP, [("p", {"ivp_b4_complete": "1"})]).withColumn("ivp_z1_complete", F.lit("2"))
    push = spark.createDataFrame([], ", ".join(f"{c} string" for c in VISIT_FIELDS))
    out = run_packet(records, push, IVP, every_form(IVP), str(tmp_path), DAY)
    assert len(lines(out.ready)) == len(lines(out.blocked)) == 1


def test_export(spark, tmp_path):
    from visitrec.plans import ready_records

    ready = ready_records(pull(spark, FVP, [("p", {"fu_artype___3": "1"})]), listed(spark, FVP, ["p"]), FVP)
    csv, text = export_text(
        ready, {"ptid": "ID", "fu_artype": "ARTYPE"}, [("ID", 4, " "), ("ARTYPE", 1, " ")], FVP, str(tmp_path), DAY
    )
    assert csv.endswith(f"NACC_UDS3_fvp_{DAY}_FILTERED.csv") and text.endswith(f"NACC_UDS3_fvp_{DAY}.txt")
    assert read_push_list(spark, csv).first()["ARTYPE"] == "3"
    assert lines(text) == ["p   3"]
