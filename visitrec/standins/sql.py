"""The checking SQL, written without the library: form lists and tests are spelled out again here."""

from __future__ import annotations

from visitrec.standins.tables import ALL_WIDE, LOCAL, REGISTRY, WIDE, derived_sql


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


REGISTRY_RAW = derived_sql("registry_raw", REGISTRY)
REGISTRY_CLEAN = r"""registry AS (
  SELECT PTID AS ptid,
    CAST(try_strptime(VISITMO || '-' || VISITDAY || '-' || VISITYR, '%m-%d-%Y') AS DATE) AS form_date,
    VISITNUM AS visitnum
  FROM registry_raw
  WHERE regexp_matches(FORMVER, '^3\.?[012]?$')
)"""
LOCAL_RAW = derived_sql("local_raw", LOCAL)
LOCAL_CLEAN = r"""local_typed AS (
  SELECT ptid,
    nullif(redcap_event_name, '') AS redcap_event_name,
    CAST(try_strptime(nullif(form_date, ''), '%Y-%m-%d') AS DATE) AS form_date,
    nullif(visitnum, '') AS visitnum,
    TRY_CAST(trunc(TRY_CAST(ivp_z1_complete AS DOUBLE)) AS INTEGER) AS ivp_z1_complete,
    TRY_CAST(trunc(TRY_CAST(fvp_z1_complete AS DOUBLE)) AS INTEGER) AS fvp_z1_complete,
    TRY_CAST(trunc(TRY_CAST(tvp_z1_complete AS DOUBLE)) AS INTEGER) AS tvp_z1_complete,
    TRY_CAST(trunc(TRY_CAST(m1_complete AS DOUBLE)) AS INTEGER) AS m1_complete
  FROM local_raw
  WHERE regexp_matches(ptid, '^UM\d{8}$')
),
local_visits AS (
  SELECT * FROM local_typed
  WHERE form_date IS NOT NULL
    AND (ivp_z1_complete = 2 OR fvp_z1_complete = 2 OR tvp_z1_complete = 2 OR m1_complete = 2)
)"""
SIDES = (REGISTRY_RAW, REGISTRY_CLEAN, LOCAL_RAW, LOCAL_CLEAN)

_SAME_KEY = (
    "a.ptid IS NOT DISTINCT FROM b.ptid AND a.form_date IS NOT DISTINCT FROM b.form_date"
    " AND a.visitnum IS NOT DISTINCT FROM b.visitnum"
)
_LOCAL_COLUMNS = (
    "a.ptid, a.form_date, a.visitnum, a.redcap_event_name, a.ivp_z1_complete,"
    " a.fvp_z1_complete, a.tvp_z1_complete, a.m1_complete"
)
_KEYS = "a.ptid, a.form_date, a.visitnum"


def _exists(other: str) -> str:
    return f"EXISTS (SELECT 1 FROM {other} b WHERE {_SAME_KEY})"


PUSH_LIST = (
    f"push_list AS (\n  SELECT {_LOCAL_COLUMNS}\n  FROM local_visits a"
    f" WHERE NOT {_exists('registry')}\n)"
)

_FIRST = "redcap_event_name = 'visit_1_arm_1' AND visitnum = '001'"
_LATER = "redcap_event_name <> 'visit_1_arm_1' AND visitnum <> '001'"
_ROUTES = {
    "ivp": f"{_FIRST} AND ivp_z1_complete = 2",
    "fvp": f"{_LATER} AND fvp_z1_complete = 2",
    "tvp": f"{_LATER} AND tvp_z1_complete = 2",
    "tvpc2": f"{_LATER} AND tvp_z1_complete = 2",
}

_VERIFIED = {
    "ivp": "header ivp_a1 ivp_a2 ivp_a3 ivp_a4 ivp_a5 ivp_b1 ivp_b4 ivp_b5 ivp_b6 ivp_b7 ivp_b8 ivp_b9"
    " ivp_c2 ivp_d1 ivp_d2",
    "fvp": "header fvp_a1 fvp_a2 fvp_a3 fvp_a4 fvp_b1 fvp_b4 fvp_b5 fvp_b6 fvp_b7 fvp_b8 fvp_b9"
    " fvp_c2 fvp_d1 fvp_d2",
    "tvp": "header tvp_t1 tvp_a1 tvp_a2 tvp_a3 tvp_a4 tvp_b4 tvp_b5 tvp_b7 tvp_b9 tvp_d1 tvp_d2",
    "tvpc2": "header tvp_t1 tvp_a1 tvp_a2 tvp_a3 tvp_a4 tvp_b4 tvp_b5 tvp_b7 tvp_b9 tvp_c2t tvp_d1"
    " tvp_d2",
}
_SHOWN = {
    "ivp": _VERIFIED["ivp"],
    "fvp": "header fvp_a1 fvp_a2 fvp_a3 fvp_a4 fvp_a5 fvp_b1 fvp_b4 fvp_b5 fvp_b6 fvp_b7 fvp_b8 fvp_b9"
    " fvp_c1 fvp_c2 fvp_d1 fvp_d2",
    "tvp": _VERIFIED["tvpc2"],
    "tvpc2": _VERIFIED["tvpc2"],
}
_GROUPS = {
    "ivp": ["arthtype", "artype"],
    "fvp": ["fu_arthtype", "fu_artype"],
    "tvp": ["tele_artype"],
    "tvpc2": ["tele_artype"],
}
_EVENT = {
    "ivp": "redcap_event_name = 'visit_1_arm_1'",
    "fvp": "redcap_event_name <> 'visit_1_arm_1'",
    "tvp": "redcap_event_name <> 'visit_1_arm_1'",
    "tvpc2": "redcap_event_name <> 'visit_1_arm_1'",
}
_DROPPED = "dob mrn madc_id cues_id tb_id cues_tbid paper_visit_num".split()


def _packet(name: str) -> tuple[str, list[str]]:
    columns = WIDE["tvp" if name == "tvpc2" else name]
    nulled = ",\n    ".join(f"nullif({c}, '') AS {c}" for c in columns)
    return (
        _with(
            *SIDES,
            PUSH_LIST,
            f"routed AS (\n  SELECT ptid, visitnum FROM push_list WHERE {_ROUTES[name]}\n)",
            derived_sql("wide_raw", columns, "orders"),
            f"wide AS (\n  SELECT\n    {nulled}\n  FROM wide_raw\n)",
        ),
        list(columns),
    )


def _ready(name: str) -> str:
    head, columns = _packet(name)
    kept = [c for c in columns if c not in _DROPPED and "___" not in c]
    groups = [
        f"CASE WHEN w.{g}___1 = '1' THEN 1 WHEN w.{g}___2 = '1' THEN 2"
        f" WHEN w.{g}___3 = '1' THEN 3 WHEN w.{g}___9 = '1' THEN 9 END AS {g}"
        for g in _GROUPS[name]
    ]
    tests = [f"w.{form}_complete = '2'" for form in _VERIFIED[name].split()]
    if name == "tvp":
        tests.append("w.tvp_c2t_complete <> '2'")
    return (
        f"{head}SELECT {', '.join([f'w.{c}' for c in kept] + groups)}\n"
        "FROM wide w JOIN routed r ON w.ptid = r.ptid AND w.visitnum = r.visitnum\n"
        f"WHERE w.{_EVENT[name]}\n"
        r"  AND regexp_matches(w.redcap_event_name, 'visit_\d{1,2}_arm_1')"
        f"\n  AND {' AND '.join(tests)}"
    )


def _blocked(name: str) -> str:
    head, _ = _packet(name)
    tests = [f"{form}_complete <> '2'" for form in _VERIFIED[name].split()]
    if name == "tvp":
        tests.append("tvp_c2t_complete = '2'")
    shown = ", ".join(f"{form}_complete" for form in _SHOWN[name].split())
    return (
        f"{head}SELECT ptid, redcap_event_name, form_date, {shown}\nFROM wide\n"
        f"WHERE ptid IN (SELECT ptid FROM routed) AND {_EVENT[name]}\n"
        f"  AND ({' OR '.join(tests)})"
    )


def _verdicts() -> str:
    nulled = ", ".join(f"nullif({c}, '') AS {c}" for c in ALL_WIDE)
    parts = []
    for name in _EVENT:
        tests = {
            "ready": [f"{form}_complete = '2'" for form in _VERIFIED[name].split()],
            "blocked": [f"{form}_complete <> '2'" for form in _VERIFIED[name].split()],
        }
        if name == "tvp":
            tests["ready"].append("tvp_c2t_complete <> '2'")
            tests["blocked"].append("tvp_c2t_complete = '2'")
        tests["ready"].append(r"regexp_matches(redcap_event_name, 'visit_\d{1,2}_arm_1')")
        for verdict, word in (("ready", " AND "), ("blocked", " OR ")):
            parts.append(
                f"SELECT sample_code, ptid, visitnum, '{name}' AS packet, '{verdict}' AS verdict FROM wide\n"
                f"WHERE {_EVENT[name]} AND ({word.join(tests[verdict])})"
            )
    head = _with(derived_sql("wide_raw", ALL_WIDE, "orders"), f"wide AS (SELECT {nulled} FROM wide_raw)")
    return head + "\nUNION ALL\n".join(parts)


_COUNT_ROWS = [
    ("left", "left_only", "local_visits", f"NOT {_exists('registry')}"),
    ("left", "both", "local_visits", _exists("registry")),
    ("right", "right_only", "registry", f"NOT {_exists('local_visits')}"),
    ("right", "both", "registry", _exists("local_visits")),
]

_PROJECTED = [
    "ptid",
    "visitnum",
    *_DROPPED,
    "sample_code",
    "header_complete",
    *[f"fu_artype___{code}" for code in (1, 2, 3, 9)],
    "fvp_d2_complete",
]

ORACLE_SQL: dict[str, str] = {
    "registry_clean": _with(REGISTRY_RAW, REGISTRY_CLEAN) + "SELECT * FROM registry",
    "local_clean": _with(LOCAL_RAW, LOCAL_CLEAN) + "SELECT * FROM local_visits",
    "push_list": _with(*SIDES, PUSH_LIST) + "SELECT * FROM push_list",
    "registry_only": _with(*SIDES)
    + f"SELECT {_KEYS} FROM registry a WHERE NOT {_exists('local_visits')}",
    "matched_registry": _with(*SIDES)
    + f"SELECT {_KEYS} FROM registry a WHERE {_exists('local_visits')}",
    "matched_local": _with(*SIDES)
    + f"SELECT {_KEYS} FROM local_visits a WHERE {_exists('registry')}",
    "tagged_local": _with(*SIDES)
    + f"SELECT {_LOCAL_COLUMNS}, CASE WHEN {_exists('registry')} THEN 'both' ELSE 'left_only' END"
    " AS status FROM local_visits a",
    "tagged_registry": _with(*SIDES)
    + f"SELECT {_KEYS}, CASE WHEN {_exists('local_visits')} THEN 'both' ELSE 'right_only' END"
    " AS status FROM registry a",
    "reconcile_status_counts": _with(*SIDES)
    + "\nUNION ALL\n".join(
        f"SELECT '{side}' AS side, '{status}' AS status, count(*) AS n_rows FROM {table} a WHERE {test}"
        for side, status, table, test in _COUNT_ROWS
    ),
    "registry_discrepancy": _with(*SIDES)
    + "SELECT count(*) AS n_registry_only, count(*) > 0 AS must_resolve"
    f" FROM registry a WHERE NOT {_exists('local_visits')}",
    "orders_without_lines": """
SELECT o_orderkey AS orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "routed_visits": _with(*SIDES, PUSH_LIST)
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS packet, ptid, visitnum FROM push_list WHERE {test}"
        for name, test in _ROUTES.items()
    ),
    **{f"ready_{name}": _ready(name) for name in _ROUTES},
    **{f"blocked_{name}": _blocked(name) for name in _ROUTES},
    "form_projection": _with(derived_sql("wide_raw", WIDE["fvp"], "orders"))
    + f"SELECT {', '.join(f'''nullif({c}, '') AS {c}''' for c in _PROJECTED)} FROM wide_raw",
    "requested_orders": """
SELECT o_custkey AS custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')""",
    "sieved_orders": """
SELECT o_custkey AS custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')""",
    "key_batches": """
WITH ids AS (SELECT DISTINCT 'UM' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ptid FROM orders),
dealt AS (
  SELECT ptid, CAST('0x' || left(md5(ptid), 8) AS BIGINT)
    % greatest(1, (SELECT (count(*) + 99) // 100 FROM ids)) AS bucket
  FROM ids
), placed AS (
  SELECT *, (row_number() OVER (PARTITION BY bucket ORDER BY ptid) - 1) // 100 AS part FROM dealt
)
SELECT bucket || '-' || part AS batch, CAST(count(*) AS INTEGER) AS n_ids,
  string_agg(ptid, ',' ORDER BY ptid) AS id_list
FROM placed GROUP BY bucket, part""",
    "date_from_parts": """
SELECT l_orderkey, l_linenumber,
  CAST(try_strptime(month(l_shipdate) || '-' || CAST(l_quantity AS INTEGER) || '-' || year(l_shipdate),
    '%m-%d-%Y') AS DATE) AS built
FROM lineitem""",
    "iso_date_not_null": """
WITH dated AS (
  SELECT l_orderkey, l_linenumber, CAST(try_strptime(
    CASE WHEN l_tax = 0.08 THEN 'bad' WHEN l_tax = 0.07 THEN CAST(year(l_shipdate) AS VARCHAR)
      ELSE year(l_shipdate) || '-' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0')
        || '-' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0') END,
    '%Y-%m-%d') AS DATE) AS read_date
  FROM lineitem
)
SELECT * FROM dated WHERE read_date IS NOT NULL""",
    "version_regex": r"SELECT * FROM part WHERE regexp_matches(p_brand, '^Brand#1\.?[012]?$')",
    "status_suffix_to_int": """
SELECT l_orderkey, CAST(trunc(l_quantity) AS INTEGER) AS quantity_complete,
  CAST(trunc(l_discount) AS INTEGER) AS "discount_COMPLETE",
  CAST(trunc(l_extendedprice) AS INTEGER) AS price_complete,
  CAST(NULL AS INTEGER) AS "flag_Complete", l_linestatus AS complete_status
FROM lineitem""",
    "blank_to_null": """
SELECT o_orderkey, o_custkey, nullif(replace(o_orderstatus, 'P', ''), '') AS o_orderstatus, o_totalprice,
  o_orderdate, nullif(replace(o_orderpriority, '5-LOW', ''), '') AS o_orderpriority
FROM orders""",
    "any_complete": """
WITH lines AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END AS known
  FROM lineitem
)
SELECT * FROM lines WHERE l_linenumber = 2 OR known = 2""",
    "checkbox_collapse": """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_linestatus = 'F' THEN 2
    WHEN l_tax = 0 THEN 3 WHEN l_discount = 0 THEN 9 END AS kind
FROM lineitem""",
    "drop_identifiers": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "newest_row": "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1",
    "freshness": """
SELECT props AS path, CAST(ts - INTERVAL 5 HOUR AS DATE) AS file_date, DATE '2024-01-31' AS run_date,
  CAST(ts - INTERVAL 5 HOUR AS DATE) <> DATE '2024-01-31' AS is_stale
FROM events ORDER BY ts DESC, event_id LIMIT 1""",
    "json_records": """
SELECT json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS note FROM events
UNION ALL
SELECT NULL AS k, event_type AS note FROM events""",
    "rename_headers": """
SELECT c_custkey AS "ID", c_name, c_nationkey, c_acctbal, c_mktsegment AS "SEGMENT" FROM customer""",
    "text_records": """
SELECT rpad(CAST(l_orderkey AS VARCHAR), 12, ' ') || rpad(CAST(l_linenumber AS VARCHAR), 2, '.')
  || rpad(CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE '' END, 3, '_') AS value
FROM lineitem""",
    "text_records_file": """
SELECT rpad(CAST(l_orderkey AS VARCHAR), 12, ' ') || rpad(CAST(l_linenumber AS VARCHAR), 2, '.')
  || rpad(CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE '' END, 3, '_') AS value
FROM lineitem""",
    "registry_only_csv": _with(*SIDES)
    + "SELECT ptid, CAST(form_date AS VARCHAR) AS form_date, visitnum FROM registry a"
    + f" WHERE NOT {_exists('local_visits')}",
    "registry_csv": _with(REGISTRY_RAW)
    + "SELECT PTID, TRY_CAST(VISITMO AS INTEGER) AS VISITMO, TRY_CAST(VISITDAY AS INTEGER) AS VISITDAY,"
    " TRY_CAST(VISITYR AS INTEGER) AS VISITYR, VISITNUM, FORMVER FROM registry_raw",
    "push_list_csv": _with(*SIDES, PUSH_LIST)
    + "SELECT ptid, CAST(form_date AS VARCHAR) AS form_date, visitnum, redcap_event_name,"
    + ", ".join(
        f" CAST({c} AS VARCHAR) AS {c}"
        for c in ("ivp_z1_complete", "fvp_z1_complete", "tvp_z1_complete", "m1_complete")
    )
    + " FROM push_list",
    "visit_json": _with(LOCAL_RAW)
    + f"SELECT {', '.join(f'''nullif({c}, '') AS {c}''' for c in LOCAL)} FROM local_raw",
    "document_csv": r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang,
  CASE WHEN trim(text, E' \t') NOT IN ('', 'NA') THEN trim(text, E' \t') END AS text
FROM documents""",
}

ORACLE_SQL["id_list"] = """
SELECT count(*) AS n_ids, coalesce(string_agg(ptid, ',' ORDER BY ptid), '') AS id_list
FROM (SELECT DISTINCT 'UM' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ptid FROM orders)"""
ORACLE_SQL["packet_verdicts"] = _verdicts()
ORACLE_SQL["visit_array"] = ORACLE_SQL["visit_json"]
ORACLE_SQL["registry_by_name"] = ORACLE_SQL["registry_csv"]
