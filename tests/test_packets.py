"""The rules, routing, gates and shaping of the four packets, one record per trap or quirk."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from visitrec.operators import (
    blanks_to_null,
    collapse_checkboxes,
    drop_required,
    form_columns,
    integers_by_suffix,
    keys_first,
    only_in,
    in_both,
    rename_headers,
)
from visitrec.plans import (
    FVP,
    IVP,
    PACKETS,
    TVP,
    TVP_C2,
    VISIT_KEYS,
    blocked_records,
    clean_local,
    clean_registry,
    pull_records,
    ready_records,
    route,
    route_all,
)
from visitrec.plans.rules import IDENTIFIERS, VISIT_FIELDS
from visitrec.sources.csv_files import declare_integers

REGISTRY = [
    ("UM00000001", "3", "5", "2019", "001", "3"),
    ("UM00000002", "2", "30", "2019", "001", "3.0"),
    ("UM00000003", None, "5", "2019", "001", "3.2"),
    ("UM00000004", "4", "6", "2019", None, "3"),
    ("UM00000005", "4", "6", "2019", "001", "2"),
    ("UM00000006", "4", "6", "2019", "001", "30"),
    ("UM00000007", "x", "6", "2019", "001", "3"),
    ("UM00000008", "4", "6", "2019", "001", None),
    ("UM00000001", "3", "5", "2019", "1", "3"),
]
FIRST, SECOND = "visit_1_arm_1", "visit_2_arm_1"
LOCAL = [
    ("UM00000001", FIRST, "2019-03-05", "001", "2", "0", "0", "0"),
    ("UM00000009", FIRST, "2019-05-01", "001", "2", "", "", ""),
    ("UM00000004", FIRST, "2019-04-06", "", "2", "0", "0", "0"),
    ("UM00000010--1", FIRST, "2019-05-01", "001", "2", "0", "0", "0"),
    ("UM00000011", FIRST, "", "001", "2", "0", "0", "0"),
    ("UM00000012", FIRST, "bad", "001", "2", "0", "0", "0"),
    ("UM00000013", FIRST, "2019-05-01", "001", "1", "0", "", "0"),
    ("UM00000014", SECOND, "2020-05-01", "002", "0", "2", "2", "0"),
    ("UM00000015", SECOND, "2020-05-01", "002", "0", "0", "0", "2"),
    ("UM00000016", FIRST, "2020-05-01", "002", "2", "0", "0", "0"),
    ("UM00000017", SECOND, "2020-05-01", "", "0", "2", "0", "0"),
    ("UM00000018", SECOND, "2020-05-01", "002", "0", "2.7", "0", "0"),
    ("UM00000019", SECOND, "2020-05-01", "002", "0", "2", "0", "0"),
    ("UM00000019", SECOND, "2020-06-01", "002", "0", "2", "0", "0"),
]


@pytest.fixture(scope="module")
def registry(spark):
    columns = ["PTID", "VISITMO", "VISITDAY", "VISITYR", "VISITNUM", "FORMVER"]
    raw = spark.createDataFrame(REGISTRY, ", ".join(f"{c} string" for c in columns))
    return clean_registry(declare_integers(raw))


@pytest.fixture(scope="module")
def local(spark):
    raw = spark.createDataFrame(LOCAL, ", ".join(f"{c} string" for c in VISIT_FIELDS))
    return clean_local(blanks_to_null(raw))


@pytest.fixture(scope="module")
def push_list(local, registry):
    return keys_first(only_in(local, registry, VISIT_KEYS), VISIT_KEYS)


def people(df):
    return sorted(int(row.ptid[2:]) for row in df.collect())


def test_clean_registry(registry):
    rows = sorted(registry.collect(), key=str)
    assert [(int(r.ptid[2:]), r.form_date, r.visitnum) for r in rows] == [
        (1, dt.date(2019, 3, 5), "001"),
        (1, dt.date(2019, 3, 5), "1"),
        (2, None, "001"),
        (3, None, "001"),
        (4, dt.date(2019, 4, 6), None),
        (6, dt.date(2019, 4, 6), "001"),
        (7, None, "001"),
    ]


def test_clean_local(local):
    assert people(local) == [1, 4, 9, 14, 15, 16, 17, 18, 19, 19]
    assert local.filter("ptid = 'UM00000018'").first().fvp_z1_complete == 2
    assert dict(local.dtypes)["m1_complete"] == "int"


def test_reconcile(local, registry, push_list):
    assert people(only_in(registry, local, VISIT_KEYS)) == [1, 2, 3, 6, 7]
    assert people(in_both(registry, local, VISIT_KEYS)) == [1, 4]
    assert people(push_list) == [9, 14, 15, 16, 17, 18, 19, 19]
    assert push_list.columns[:4] == [*VISIT_KEYS, "redcap_event_name"]


def test_routing(push_list):
    assert people(route(push_list, IVP)) == [9]
    assert people(route(push_list, FVP)) == [14, 18, 19, 19]
    assert people(route(push_list, TVP)) == people(route(push_list, TVP_C2)) == [14]
    together = sorted((r.packet, r.ptid, r.visitnum) for r in route_all(push_list).collect())
    one_by_one = [(p.name, r.ptid, r.visitnum) for p in PACKETS for r in route(push_list, p).collect()]
    assert together == sorted(one_by_one)


def test_routing_is_the_same_on_text(push_list):
    text = push_list.select(*[F.col(c).cast("string").alias(c) for c in push_list.columns])
    assert people(route(text, FVP)) == [14, 18, 19, 19]


def test_rule_sizes():
    assert [len(r.required) for r in PACKETS] == [16, 15, 12, 13]
    assert [len(r.shown) for r in PACKETS] == [16, 17, 13, 13]
    assert [len(r.pulled) for r in PACKETS] == [17, 19, 15, 15]
    assert [r.excluded for r in PACKETS] == [(), (), ("tvp_c2t",), ()]


def pull(spark, rule, rows):
    """Records of a packet: all verified, but for the given differences."""
    event, visit = (FIRST, "001") if rule.first_visit else (SECOND, "002")
    boxes = [f"{g}___{code}" for g in rule.checkbox_groups for code in (1, 2, 3, 9)]
    base = {
        "ptid": None,
        "redcap_event_name": event,
        "form_date": "2020-01-01",
        "visitnum": visit,
        **{c: "secret" for c in IDENTIFIERS},
        "answer": "7",
        **{f"{form}_complete": "2" for form in rule.shown},
        **{box: "0" for box in boxes},
    }
    names = list(base)
    data = [tuple({**base, "ptid": ptid, **change}[n] for n in names) for ptid, change in rows]
    return blanks_to_null(spark.createDataFrame(data, ", ".join(f"{n} string" for n in names)))


def listed(spark, rule, ptids):
    visit = "001" if rule.first_visit else "002"
    return spark.createDataFrame([(p, visit) for p in ptids], "ptid string, visitnum string")


def split(spark, rule, rows, routed):
    records = pull(spark, rule, rows)
    ready = sorted(r.ptid for r in ready_records(records, listed(spark, rule, routed), rule).collect())
    blocked = sorted(r.ptid for r in blocked_records(records, rule).collect())
    return ready, blocked


def test_first_visit_gates(spark):
    rows = [
        ("p1", {}),
        ("p2", {"ivp_b4_complete": "1"}),
        ("p3", {"ivp_b4_complete": ""}),
        ("p4", {"ivp_b4_complete": "", "ivp_b5_complete": "0"}),
        ("p5", {"ivp_b4_complete": "02"}),
        ("p6", {"ivp_b4_complete": "x"}),
        ("p7", {"ivp_b4_complete": "1"}),
        ("p8", {}),
        ("p9", {"redcap_event_name": SECOND, "ivp_b4_complete": "1"}),
    ]
    ready, blocked = split(spark, IVP, rows, ["p1", "p2", "p3", "p4", "p5", "p6", "p9"])
    assert ready == ["p1"]
    assert blocked == ["p2", "p4", "p5", "p6", "p7"]


@pytest.mark.parametrize("rule", PACKETS, ids=lambda r: r.name)
def test_every_required_form_counts(spark, rule):
    verified = {f"{form}_complete": "0" for form in rule.excluded}
    rows = [(form, {**verified, f"{form}_complete": "0"}) for form in rule.required]
    rows.append(("good", verified))
    names = [name for name, _ in rows]
    ready, blocked = split(spark, rule, rows, names)
    assert ready == ["good"]
    assert blocked == sorted(rule.required)


def test_follow_up_gates(spark):
    rows = [
        ("p1", {"fvp_a5_complete": "0", "fvp_c1_complete": "0"}),
        ("p2", {"redcap_event_name": "misc_arm_1", "fvp_b4_complete": "1"}),
        ("p3", {"redcap_event_name": "misc_arm_1"}),
        ("p4", {"redcap_event_name": ""}),
        ("p5", {"redcap_event_name": "xvisit_12_arm_10"}),
        ("p6", {"redcap_event_name": FIRST, "fvp_b4_complete": "1"}),
    ]
    ready, blocked = split(spark, FVP, rows, ["p1", "p2", "p3", "p4", "p5", "p6"])
    assert ready == ["p1", "p5"]
    assert blocked == ["p2"]


@pytest.mark.parametrize(
    "c2t, expected",
    [("2", (False, True, True, False)), ("0", (True, False, False, True)), ("", (False,) * 4)],
)
def test_telephone_pair(spark, c2t, expected):
    rows = [("p", {"tvp_c2t_complete": c2t})]
    found = [bool(part) for rule in (TVP, TVP_C2) for part in split(spark, rule, rows, ["p"])]
    assert tuple(found) == expected


def test_listed_twice_comes_twice(spark):
    ready, blocked = split(spark, FVP, [("p", {}), ("q", {"fvp_a1_complete": "1"})], ["p", "p", "q"])
    assert ready == ["p", "p"]
    assert blocked == ["q"]


@pytest.mark.parametrize("rule", PACKETS, ids=lambda r: r.name)
def test_ready_shape(spark, rule):
    group = rule.checkbox_groups[0]
    change = {f"{form}_complete": "0" for form in rule.excluded}
    records = pull(spark, rule, [("p", {**change, f"{group}___2": "1", f"{group}___9": "1"})])
    ready = ready_records(records, listed(spark, rule, ["p"]), rule)
    assert not set(IDENTIFIERS) & set(ready.columns)
    assert not [c for c in ready.columns if "___" in c]
    assert ready.columns[-len(rule.checkbox_groups) :] == list(rule.checkbox_groups)
    kept = [c for c in records.columns if c not in IDENTIFIERS and "___" not in c]
    assert ready.columns == [*kept, *rule.checkbox_groups]
    row = ready.first()
    assert row[group] == 2 and row.answer == "7"


@pytest.mark.parametrize("rule", PACKETS, ids=lambda r: r.name)
def test_blocked_shape(spark, rule):
    blocked = blocked_records(pull(spark, rule, [("p", {})]), rule)
    assert blocked.columns == [
        "ptid", "redcap_event_name", "form_date", *[f"{form}_complete" for form in rule.shown]
    ]


def test_missing_identifier_stops_the_run(spark):
    records = pull(spark, IVP, [("p", {})]).drop("mrn")
    with pytest.raises(ValueError, match="mrn"):
        ready_records(records, listed(spark, IVP, ["p"]), IVP)


def test_pull_takes_all_visits_of_listed_people(spark):
    dictionary = {form: [] for form in IVP.pulled}
    dictionary["header"] = ["answer"]
    dictionary["ivp_a5"] = ["arthtype"]
    rows = [("p", {}), ("p", {"visitnum": "009"}), ("q", {})]
    records = pull(spark, IVP, rows).withColumn("ivp_z1_complete", F.lit("2"))
    pulled = pull_records(records, listed(spark, IVP, ["p", "p"]), IVP, dictionary)
    assert sorted((r.ptid, r.visitnum) for r in pulled.collect()) == [("p", "001"), ("p", "009")]
    assert pulled.columns[:6] == ["ptid", "redcap_event_name", "form_date", "visitnum", "answer", "header_complete"]
    assert [c for c in pulled.columns if "___" in c] == [f"arthtype___{code}" for code in (1, 2, 3, 9)]


def test_no_join_before_the_gate(spark):
    """The gate's filter sits under the join, at the scan of the records."""
    records = pull(spark, IVP, [("p", {})])
    ready = ready_records(records, listed(spark, IVP, ["p"]), IVP)
    plan = ready._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("ivp_d2_complete#", plan.index("Filter"))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_column_helpers(spark):
    df = spark.createDataFrame([("1", "2.7", "x", 5)], "a string, b_complete string, C_COMPLETE string, n int")
    assert tuple(integers_by_suffix(df).first()) == ("1", 2, None, 5)
    assert keys_first(df, ["n", "a"]).columns == ["n", "a", "b_complete", "C_COMPLETE"]
    assert rename_headers(df, {"a": "A1"}).columns == ["A1", "b_complete", "C_COMPLETE", "n"]
    for bad in ({"zz": "q"}, {"a": "n"}):
        with pytest.raises(ValueError):
            rename_headers(df, bad)
    with pytest.raises(ValueError):
        drop_required(df, ["a", "zz"])
    with pytest.raises(ValueError):
        collapse_checkboxes(df, ["kind"])
    with pytest.raises(ValueError):
        form_columns(df, ["b"], {}, ["a"])
    with pytest.raises(ValueError):
        form_columns(df, ["b"], {"b": ["zz"]}, ["a"])
    assert form_columns(df, ["b"], {"b": ["n"]}, ["a"]).columns == ["a", "n", "b_complete"]
