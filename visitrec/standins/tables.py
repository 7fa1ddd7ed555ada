"""Visit-shaped tables, derived row by row from the whole ``lineitem`` and ``orders`` tables.

The sample tables hold no visits. A line item stands for one visit: its part is the participant, its
line number the visit, its ship month the visit date. An order stands for one wide form record: its
customer is the participant, its priority the visit, its day of the month decides the form statuses.
The other columns decide faults. The expressions are plain SQL that Spark and the checking engine
read alike; they only make the input, and nothing of the library is in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PTID = "'UM' || lpad(cast(l_partkey as string), 8, '0')"
_MONTH = "substr(ship_text, 1, 7) || '-01'"

# The registry's download: date parts as text, some impossible, some missing.
REGISTRY = {
    "PTID": _PTID,
    "VISITMO": "case when l_tax = 0.04 then 'x' else substr(ship_text, 6, 2) end",
    "VISITDAY": "case when l_tax = 0.03 then '31' else '1' end",
    "VISITYR": "case when l_tax <> 0.02 then substr(ship_text, 1, 4) end",
    "VISITNUM": "case when l_discount <> 0.08 then '00' || cast(l_linenumber as string) end",
    "FORMVER": (
        "case when l_quantity <= 10 then '3' when l_quantity <= 20 then '3.0'"
        " when l_quantity <= 25 then '3.2' when l_quantity <= 30 then '30'"
        " when l_quantity <= 35 then '3.5' when l_quantity <= 40 then '2' end"
    ),
}

_LOCAL_PTID = f"{_PTID} || case when l_tax = 0.08 then '--1' else '' end"
_EVENT = (
    "case when l_discount = 0.09 then 'misc_arm_1' when l_discount = 0.10 then ''"
    " else 'visit_' || cast(l_linenumber as string) || '_arm_1' end"
)
_FORM_DATE = (
    "case when l_tax = 0.07 then '' when l_tax = 0.06 then 'bad'"
    " when l_tax = 0.05 then substr(ship_text, 1, 4) || '-02-30'"
    f" else {_MONTH} end"
)
_VISITNUM = (
    "case when l_discount = 0.08 then '' when l_discount = 0.07 then '001'"
    " else '00' || cast(l_linenumber as string) end"
)

# The local system's visits: all text, '' for missing, double-entry ids, bad dates.
LOCAL = {
    "ptid": _LOCAL_PTID,
    "redcap_event_name": _EVENT,
    "form_date": _FORM_DATE,
    "visitnum": _VISITNUM,
    "ivp_z1_complete": (
        "case when l_linenumber > 1 then '' when l_returnflag = 'A' then '2'"
        " when l_returnflag = 'N' then '2.7' else '1' end"
    ),
    "fvp_z1_complete": (
        "case when l_linenumber = 1 then '0' when l_returnflag = 'A' then '2'"
        " when l_returnflag = 'N' then '0' else '' end"
    ),
    "tvp_z1_complete": (
        "case when l_linenumber = 1 or l_linestatus = 'O' then ''"
        " when l_returnflag = 'N' then 'x' else '2' end"
    ),
    "m1_complete": "case when l_quantity > 45 then '2' else '0' end",
}

_PACKET_FORMS = {
    "ivp": "a1 a2 a3 a4 a5 b1 b4 b5 b6 b7 b8 b9 c2 d1 d2",
    "fvp": "a1 a2 a3 a4 a5 b1 b4 b5 b6 b7 b8 b9 c1 c2 d1 d2",
    "tvp": "t1 a1 a2 a3 a4 b4 b5 b7 b9 d1 d2",
}


def _status(position: int) -> str:
    """One form's status by the day of the month: verified but for a few days of its own.

    On its own day the form is not verified; some forms are blank late in the month, alone or while
    another form holds a code that is no number.
    """
    by_day = ["2"] * 31
    by_day[position - 1] = "1"
    if position == 11:
        by_day[29:] = "xx"
    filled = {4: 28, 9: 27, 13: 30}.get(position, 31)
    return f"substr('{''.join(by_day[:filled])}', dom, 1)"


_C2T = "case when o_orderstatus = 'O' then '2' when o_totalprice > 300000 then '' else '0' end"

_BOXES = {
    "1": "case when o_orderstatus = 'F' then '1' else '0' end",
    "2": "case when o_totalprice > 250000 then '1' else '' end",
    "3": "case when o_orderstatus = 'P' then '1' else '0' end",
    "9": "case when o_totalprice > 125000 then '1' else '' end",
}
_OTHER_BOXES = {
    "1": "case when o_totalprice > 400000 then '1' else '' end",
    "2": "case when o_orderstatus = 'O' then '1' else '0' end",
    "3": "case when o_totalprice > 200000 then '1' else '0' end",
    "9": "case when o_orderstatus = 'P' then '1' else '' end",
}

_IDENTIFIERS = {
    "dob": "order_text",
    "mrn": "cast(o_orderkey as string)",
    "madc_id": "cast(o_custkey as string)",
    "cues_id": "o_orderpriority",
    "tb_id": "o_orderstatus",
    "cues_tbid": "o_orderstatus",
    "paper_visit_num": "o_orderpriority",
}

_WIDE_COMMON = {
    "ptid": "'UM' || lpad(cast(o_custkey as string), 8, '0')",
    "redcap_event_name": (
        "case when o_totalprice > 480000 then 'misc_arm_1' when o_totalprice > 460000 then ''"
        " else 'visit_' || substr(o_orderpriority, 1, 1) || '_arm_1' end"
    ),
    "form_date": "order_text",
    "visitnum": (
        "case when o_totalprice < 20000 then '' else '00' || substr(o_orderpriority, 1, 1) end"
    ),
    **_IDENTIFIERS,
    "sample_code": "cast(o_orderkey as string) || o_orderstatus",
}


def _wide(packet: str, groups: dict[str, dict[str, str]]) -> dict[str, str]:
    columns = {**_WIDE_COMMON, "header_complete": _status(1)}
    for position, form in enumerate(_PACKET_FORMS[packet].split(), start=2):
        columns[f"{packet}_{form}_complete"] = _status(position)
    if packet == "tvp":
        columns["tvp_c2t_complete"] = _C2T
    if packet != "ivp":
        columns["ivp_a1_complete"] = "'2'"
    columns[f"{packet}_z1_complete"] = "case when o_orderstatus = 'F' then '2' else '' end"
    for prefix, boxes in groups.items():
        for code, box in boxes.items():
            columns[f"{prefix}___{code}"] = box
    return columns


# The wide form data of each packet type: all text, '' for missing, identifiers included.
WIDE = {
    "ivp": _wide("ivp", {"arthtype": _BOXES, "artype": _OTHER_BOXES}),
    "fvp": _wide("fvp", {"fu_arthtype": _OTHER_BOXES, "fu_artype": _BOXES}),
    "tvp": _wide("tvp", {"tele_artype": _BOXES}),
}

# All packets' forms in one record, as the data is kept.
ALL_WIDE = {**WIDE["tvp"], **WIDE["fvp"], **WIDE["ivp"]}


def _form_dictionary(columns: dict[str, str], packet: str) -> dict[str, list[str]]:
    """Which form each field of a stand-in pull belongs to."""
    forms: dict[str, list[str]] = {
        c.removesuffix("_complete"): [] for c in columns if c.endswith("_complete")
    }
    forms["header"] = [*_IDENTIFIERS, "sample_code"]
    for field in dict.fromkeys(c.split("___")[0] for c in columns if "___" in c):
        form = "a5" if field.endswith("arthtype") else "d2"
        forms[f"{packet}_{form}"].append(field)
    return forms


DICTIONARIES = {packet: _form_dictionary(WIDE[packet], packet) for packet in WIDE}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Parts that several columns use, computed first.
_HELPERS = {
    "lineitem": {"ship_text": "cast(cast(l_shipdate as date) as string)"},
    "orders": {"dom": "day(o_orderdate)", "order_text": "cast(cast(o_orderdate as date) as string)"},
}


def _derive(spark: SparkSession, sf_dir: str, source: str, columns: dict[str, str]) -> DataFrame:
    """The one-row ``inline`` makes the columns plain attributes, as if read from a table.

    With a plain projection Catalyst would copy each expression into every filter that uses it.
    """
    fields = ", ".join(f"{sql} as {name}" for name, sql in columns.items())
    helpers = [f"{sql} as {name}" for name, sql in _HELPERS[source].items()]
    return load(spark, sf_dir, source).selectExpr("*", *helpers).selectExpr(f"inline(array(struct({fields})))")


def registry_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "lineitem", REGISTRY)


def local_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "lineitem", LOCAL)


def wide_records(spark: SparkSession, sf_dir: str, packet: str) -> DataFrame:
    return _derive(spark, sf_dir, "orders", WIDE[packet])


def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "orders", ALL_WIDE)


def derived_sql(name: str, columns: dict[str, str], source: str = "lineitem") -> str:
    """The same table as a named subquery for the checking SQL."""
    body = ",\n    ".join(f"{sql} AS {column}" for column, sql in columns.items())
    helpers = ", ".join(f"{sql} AS {column}" for column, sql in _HELPERS[source].items())
    return f"{name} AS (\n  SELECT\n    {body}\n  FROM (SELECT *, {helpers} FROM {source})\n)"
