"""One query per operator, each over whole tables. ``sql.py`` holds the check for every key here."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitrec.functions import date_from_parts, iso_date, matches
from visitrec.operators import (
    any_complete,
    blanks_to_null,
    collapse_checkboxes,
    discrepancy,
    drop_required,
    form_columns,
    id_list,
    in_both,
    in_order,
    integers_by_suffix,
    key_batches,
    keys_first,
    newest,
    only_in,
    reconcile,
    rename_headers,
    requested_only,
    sieve,
    status_counts,
)
from visitrec.plans import (
    FVP,
    IVP,
    TVP,
    TVP_C2,
    VISIT_KEYS,
    PacketRule,
    blocked_records,
    clean_local,
    clean_registry,
    pull_records,
    ready_records,
    route,
    route_all,
    verdicts,
)
from visitrec.plans.rules import RECORD_COLUMNS, REGISTRY_ONLY_STEM, VISIT_FIELDS
from visitrec.sinks import push_folder, text_records, write_csv, write_csv_if_any, write_text_records
from visitrec.sources import freshness, read_push_list, read_records, read_registry, records_from_text
from visitrec.sources.csv_files import declare_integers
from visitrec.standins import tables as t
from visitrec.storage import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    return clean_registry(declare_integers(t.registry_visits(spark, sf)))


def _local(spark: SparkSession, sf: str) -> DataFrame:
    return clean_local(blanks_to_null(t.local_visits(spark, sf)))


def _push_list(spark: SparkSession, sf: str) -> DataFrame:
    missing = only_in(_local(spark, sf), _registry(spark, sf), VISIT_KEYS)
    return keys_first(missing, VISIT_KEYS)


def _registry_only(spark: SparkSession, sf: str) -> DataFrame:
    return only_in(_registry(spark, sf), _local(spark, sf), VISIT_KEYS).select(*VISIT_KEYS)


def _matched_registry(spark: SparkSession, sf: str) -> DataFrame:
    matched = in_both(_registry(spark, sf), _local(spark, sf), VISIT_KEYS)
    return in_order(matched.select(*VISIT_KEYS), VISIT_KEYS)


def _matched_local(spark: SparkSession, sf: str) -> DataFrame:
    matched = in_both(_local(spark, sf), _registry(spark, sf), VISIT_KEYS)
    return in_order(matched.select(*VISIT_KEYS), VISIT_KEYS)


def _tagged_local(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile(_local(spark, sf), _registry(spark, sf), VISIT_KEYS)[0]


def _tagged_registry(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile(_local(spark, sf), _registry(spark, sf), VISIT_KEYS)[1]


def _status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return status_counts(_local(spark, sf), _registry(spark, sf), VISIT_KEYS)


def _discrepancy(spark: SparkSession, sf: str) -> DataFrame:
    return discrepancy(_registry(spark, sf), _local(spark, sf), VISIT_KEYS)


def _orders_without_lines(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.load(spark, sf, "orders").withColumnRenamed("o_orderkey", "orderkey")
    lines = t.load(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    return only_in(orders, lines, ["orderkey"])


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return route_all(_push_list(spark, sf))


def _wide(spark: SparkSession, sf: str, rule: PacketRule) -> tuple[DataFrame, dict]:
    packet = rule.routing_status.split("_")[0]
    return blanks_to_null(t.wide_records(spark, sf, packet)), t.DICTIONARIES[packet]


def _ready(rule: PacketRule) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        records, dictionary = _wide(spark, sf, rule)
        projected = form_columns(records, rule.pulled, dictionary, RECORD_COLUMNS)
        return ready_records(projected, route(_push_list(spark, sf), rule), rule)

    return query


def _blocked(rule: PacketRule) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        records, dictionary = _wide(spark, sf, rule)
        routed = route(_push_list(spark, sf), rule)
        return blocked_records(pull_records(records, routed, rule, dictionary), rule)

    return query


def _packet_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """What the gates of all packets say of every record, in one pass."""
    records = blanks_to_null(t.all_records(spark, sf))
    return verdicts(records).select("sample_code", "ptid", "visitnum", "packet", "verdict")


def _form_projection(spark: SparkSession, sf: str) -> DataFrame:
    records, dictionary = _wide(spark, sf, FVP)
    return form_columns(records, ["header", "fvp_d2"], dictionary, ["ptid", "visitnum"])


def _requested_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.load(spark, sf, "orders").withColumnRenamed("o_custkey", "custkey")
    customers = t.load(spark, sf, "customer").filter(F.col("c_mktsegment") == "HOUSEHOLD")
    return requested_only(orders, customers.withColumnRenamed("c_custkey", "custkey"), "custkey")


def _sieved_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.load(spark, sf, "orders").withColumnRenamed("o_custkey", "custkey")
    listed = t.load(spark, sf, "customer").filter(F.col("c_mktsegment") == "HOUSEHOLD")
    listed = listed.select(F.col("c_custkey").alias("custkey"))
    return requested_only(sieve(orders, listed, "custkey", listed.count()), listed, "custkey")


def _key_batches(spark: SparkSession, sf: str) -> DataFrame:
    owner = F.lpad(F.col("o_custkey").cast("string"), 8, "0")
    orders = t.load(spark, sf, "orders").select(F.concat(F.lit("UM"), owner).alias("ptid"))
    return key_batches(orders, "ptid", size=100)


def _id_list(spark: SparkSession, sf: str) -> DataFrame:
    owner = F.lpad(F.col("o_custkey").cast("string"), 8, "0")
    orders = t.load(spark, sf, "orders").select(F.concat(F.lit("UM"), owner).alias("ptid"))
    return id_list(orders, "ptid")


def _date_from_parts(spark: SparkSession, sf: str) -> DataFrame:
    built = date_from_parts(
        F.month("l_shipdate"), F.col("l_quantity").cast("int"), F.year("l_shipdate")
    )
    return t.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", built.alias("built"))


def _iso_dates(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr(
        "case when l_tax = 0.08 then 'bad'"
        " when l_tax = 0.07 then cast(year(l_shipdate) as string)"
        " else cast(year(l_shipdate) as string)"
        " || '-' || lpad(cast(month(l_shipdate) as string), 2, '0')"
        " || '-' || lpad(cast(cast(l_quantity as int) as string), 2, '0') end"
    )
    return (
        t.load(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", iso_date(text).alias("read_date"))
        .filter(F.col("read_date").isNotNull())
    )


def _version_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return t.load(spark, sf, "part").filter(matches("p_brand", r"^Brand#1\.?[012]?$"))


def _suffix_integers(spark: SparkSession, sf: str) -> DataFrame:
    return integers_by_suffix(
        t.load(spark, sf, "lineitem").select(
            "l_orderkey",
            F.col("l_quantity").cast("string").alias("quantity_complete"),
            F.col("l_discount").cast("string").alias("discount_COMPLETE"),
            F.col("l_extendedprice").cast("string").alias("price_complete"),
            F.col("l_returnflag").alias("flag_Complete"),
            F.col("l_linestatus").alias("complete_status"),
        )
    )


def _blanks(spark: SparkSession, sf: str) -> DataFrame:
    return blanks_to_null(
        t.load(spark, sf, "orders").withColumns(
            {
                "o_orderstatus": F.replace("o_orderstatus", F.lit("P"), F.lit("")),
                "o_orderpriority": F.replace("o_orderpriority", F.lit("5-LOW"), F.lit("")),
            }
        )
    )


def _any_complete(spark: SparkSession, sf: str) -> DataFrame:
    known = F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("int"))
    lines = t.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", known.alias("known"))
    return any_complete(lines, ["l_linenumber", "known"])


def _checkboxes(spark: SparkSession, sf: str) -> DataFrame:
    ticked = {
        1: F.col("l_returnflag") == "A",
        2: F.col("l_linestatus") == "F",
        3: F.col("l_tax") == 0,
        9: F.col("l_discount") == 0,
    }
    boxes = [F.when(test, "1").otherwise("").alias(f"kind___{code}") for code, test in ticked.items()]
    lines = t.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *boxes)
    return collapse_checkboxes(lines, ["kind"])


def _no_identifiers(spark: SparkSession, sf: str) -> DataFrame:
    return drop_required(t.load(spark, sf, "customer"), ["c_name", "c_acctbal"])


def _newest(spark: SparkSession, sf: str) -> DataFrame:
    return newest(t.load(spark, sf, "orders"), by="o_orderdate", tie="o_orderkey")


def _freshness(spark: SparkSession, sf: str) -> DataFrame:
    at_utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    events = t.load(spark, sf, "events").withColumn("ts", at_utc)
    latest = newest(events, by="ts", tie="event_id")
    return freshness(latest, "2024-01-31", path="props", modified="ts")


def _json_records(spark: SparkSession, sf: str) -> DataFrame:
    second = F.concat(F.lit(',{"note":"'), F.col("event_type"), F.lit('","k":""}'))
    text = F.concat(F.lit("["), F.col("props"), second, F.lit("]"))
    return records_from_text(t.load(spark, sf, "events"), text, ["k", "note"])


def _renamed(spark: SparkSession, sf: str) -> DataFrame:
    return rename_headers(
        t.load(spark, sf, "customer"), {"c_custkey": "ID", "c_mktsegment": "SEGMENT"}
    )


def _text_records(spark: SparkSession, sf: str) -> DataFrame:
    layout = [("l_orderkey", 12, " "), ("l_linenumber", 2, "."), ("flag", 3, "_")]
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    lines = t.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", flag)
    return text_records(lines, layout)


def _shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared folder; see shared_folder."""
    return f"{shared_folder(spark)}/visitrec/{uuid.uuid4().hex}/{name}"


def _registry_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = write_csv(t.registry_visits(spark, sf), _shared_path(spark, "registry"))
    return read_registry(spark, path)


def _push_list_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = write_csv(_push_list(spark, sf), _shared_path(spark, "push_list"))
    return read_push_list(spark, path)


def _visit_json(spark: SparkSession, sf: str) -> DataFrame:
    path = _shared_path(spark, "visits")
    t.local_visits(spark, sf).write.json(path)
    return read_records(spark, path, VISIT_FIELDS, one_array_per_file=False)


def _visit_array(spark: SparkSession, sf: str) -> DataFrame:
    """Objects side by side in long lines, as in an array; a split of a file may begin anywhere in one."""
    path = _shared_path(spark, "visit-array")
    visits = t.local_visits(spark, sf)
    visits.select(F.to_json(F.struct("*"))).write.option("lineSep", ",").text(path)
    return read_records(spark, path, VISIT_FIELDS)


def _registry_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Two downloads with their columns in different orders."""
    visits = t.registry_visits(spark, sf)
    older = F.coalesce(F.col("FORMVER").startswith("3"), F.lit(False))
    paths = [
        write_csv(visits.filter(older), _shared_path(spark, "older")),
        write_csv(visits.filter(~older).select(*reversed(visits.columns)), _shared_path(spark, "newer")),
    ]
    return read_registry(spark, paths)


def _document_csv(spark: SparkSession, sf: str) -> DataFrame:
    documents = t.load(spark, sf, "documents").select("doc_id", "lang", "text")
    return read_push_list(spark, write_csv(documents, _shared_path(spark, "documents")))


def _registry_only_csv(spark: SparkSession, sf: str) -> DataFrame:
    folder = push_folder(_shared_path(spark, "pushes"), "2024-03-02")
    rows = _registry_only(spark, sf)
    path = write_csv_if_any(rows, f"{folder}/{REGISTRY_ONLY_STEM}2024-03-02.csv")
    return read_push_list(spark, path) if path else rows


def _text_records_file(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    lines = t.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", flag)
    layout = [("l_orderkey", 12, " "), ("l_linenumber", 2, "."), ("flag", 3, "_")]
    return spark.read.text(write_text_records(lines, layout, _shared_path(spark, "records.txt")))


QUERIES: dict[str, Query] = {
    "registry_clean": _registry,
    "local_clean": _local,
    "push_list": _push_list,
    "registry_only": _registry_only,
    "matched_registry": _matched_registry,
    "matched_local": _matched_local,
    "tagged_local": _tagged_local,
    "tagged_registry": _tagged_registry,
    "reconcile_status_counts": _status_counts,
    "registry_discrepancy": _discrepancy,
    "orders_without_lines": _orders_without_lines,
    "routed_visits": _routed,
    "ready_ivp": _ready(IVP),
    "ready_fvp": _ready(FVP),
    "ready_tvp": _ready(TVP),
    "ready_tvpc2": _ready(TVP_C2),
    "blocked_ivp": _blocked(IVP),
    "blocked_fvp": _blocked(FVP),
    "blocked_tvp": _blocked(TVP),
    "blocked_tvpc2": _blocked(TVP_C2),
    "packet_verdicts": _packet_verdicts,
    "form_projection": _form_projection,
    "requested_orders": _requested_orders,
    "sieved_orders": _sieved_orders,
    "key_batches": _key_batches,
    "id_list": _id_list,
    "date_from_parts": _date_from_parts,
    "iso_date_not_null": _iso_dates,
    "version_regex": _version_pattern,
    "status_suffix_to_int": _suffix_integers,
    "blank_to_null": _blanks,
    "any_complete": _any_complete,
    "checkbox_collapse": _checkboxes,
    "drop_identifiers": _no_identifiers,
    "newest_row": _newest,
    "freshness": _freshness,
    "json_records": _json_records,
    "rename_headers": _renamed,
    "text_records": _text_records,
    "registry_csv": _registry_csv,
    "push_list_csv": _push_list_csv,
    "visit_json": _visit_json,
    "document_csv": _document_csv,
    "visit_array": _visit_array,
    "registry_by_name": _registry_by_name,
    "registry_only_csv": _registry_only_csv,
    "text_records_file": _text_records_file,
}
