"""Route the push list to packets, then split each packet's records into ready and blocked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitrec.functions import column, is_code, is_not_code, matches
from visitrec.operators import (
    all_of,
    any_of,
    collapse_checkboxes,
    drop_required,
    form_columns,
    join_listed,
    requested_only,
)
from visitrec.plans.rules import (
    EVENT_PATTERN,
    FIRST_EVENT,
    FIRST_VISIT,
    IDENTIFIERS,
    PACKETS,
    RECORD_COLUMNS,
    RECORD_KEYS,
    VERIFIED,
    VISIT_KEYS,
    PacketRule,
)

_EVENT = "redcap_event_name"
READY, BLOCKED = "ready", "blocked"


def route(push_list: DataFrame, rule: PacketRule) -> DataFrame:
    """``ptid, visitnum`` of the push-list rows that belong to the packet."""
    return push_list.filter(_routed(rule)).select(*RECORD_KEYS)


def route_all(
    push_list: DataFrame, rules: Sequence[PacketRule] = PACKETS
) -> DataFrame:
    """``packet, ptid, visitnum`` for all packets in one pass; a row may go to several packets."""
    names = F.array(*[F.when(_routed(rule), F.lit(rule.name)) for rule in rules])
    return push_list.select(
        F.explode(F.array_compact(names)).alias("packet"), *RECORD_KEYS
    )


def pull_records(
    records: DataFrame,
    routed: DataFrame,
    rule: PacketRule,
    dictionary: Mapping[str, Sequence[str]],
) -> DataFrame:
    """The packet's forms for every record, of any visit, of the routed participants."""
    return requested_only(
        form_columns(records, rule.pulled, dictionary, RECORD_COLUMNS), routed, "ptid"
    )


def ready_records(
    records: DataFrame, routed: DataFrame, rule: PacketRule, stripped: bool = False
) -> DataFrame:
    """Routed records with every required form verified, shaped for submission.

    ``stripped`` says that the identifiers have been dropped already; else they must be there.

    The gate needs one record at a time, so it runs before the join: unready records do not move.
    """
    passed = records.filter(_passes(rule))
    bare = passed if stripped else drop_required(passed, IDENTIFIERS)
    return shape_ready(bare, routed, rule)


def shape_ready(passed: DataFrame, routed: DataFrame, rule: PacketRule) -> DataFrame:
    """Records that passed the gate, without identifiers: checkboxes collapsed, the routed visits kept."""
    return join_listed(collapse_checkboxes(passed, rule.checkbox_groups), routed, RECORD_KEYS)


def blocked_records(records: DataFrame, rule: PacketRule) -> DataFrame:
    """Pulled records of the packet's events with a form that fails the gate.

    Not the rest of ``ready_records``: all pulled records count, routed or not, and a record whose
    only fault is a missing status is in neither.
    """
    return shape_blocked(records.filter(_fails(rule)), rule)


def shape_blocked(failed: DataFrame, rule: PacketRule) -> DataFrame:
    return failed.select(
        VISIT_KEYS[0], _EVENT, VISIT_KEYS[1], *[_status(form) for form in rule.shown]
    )


def verdict_mask(
    rules: Sequence[PacketRule] = PACKETS, routed: Mapping[str, Column] | None = None
) -> Column:
    """All gates of all packets in one number: bit ``2 i`` if a record passes that of rule i, the next one if it fails.

    ``routed`` holds, by packet, whether the record's participant is routed there; else both bits are 0.
    """
    mask = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        counts = (routed or {}).get(rule.name, F.lit(True))
        for bit, gate in ((2 * i, _passes(rule)), (2 * i + 1, _fails(rule))):
            mask = mask.bitwiseOR(F.when(gate & counts, F.lit(1 << bit).cast("long")).otherwise(F.lit(0)))
    return mask


def verdicts(
    records: DataFrame, rules: Sequence[PacketRule] = PACKETS, routed: Mapping[str, Column] | None = None
) -> DataFrame:
    """The records with ``packet`` and ``verdict`` (ready or blocked), once for each bit of their mask.

    "Ready" is the gate alone; which visits are routed is for the join that follows. Records without a verdict go.
    """
    listed = F.array(
        *[
            F.struct(F.lit(rule.name).alias("packet"), F.lit(verdict).alias("verdict"))
            for rule in rules
            for verdict in (READY, BLOCKED)
        ]
    )
    bits = F.filter(
        F.transform(listed, lambda x, i: F.struct(x["packet"], x["verdict"], i.alias("bit"))),
        lambda x: F.call_function("shiftright", F.col("_mask"), x["bit"]).bitwiseAND(F.lit(1)) == 1,
    )
    masked = records.withColumn("_mask", verdict_mask(rules, routed)).filter("_mask <> 0")
    return masked.withColumn("_found", F.explode(bits)).select(
        *map(column, records.columns), F.col("_found.packet").alias("packet"), F.col("_found.verdict").alias("verdict")
    )


def _passes(rule: PacketRule) -> Column:
    return (
        _event(rule)
        & matches(_EVENT, EVENT_PATTERN)
        & all_of(
            [is_code(_status(form), VERIFIED) for form in rule.required]
            + [is_not_code(_status(form), VERIFIED) for form in rule.excluded]
        )
    )


def _fails(rule: PacketRule) -> Column:
    return _event(rule) & any_of(
        [is_not_code(_status(form), VERIFIED) for form in rule.required]
        + [is_code(_status(form), VERIFIED) for form in rule.excluded]
    )


def _routed(rule: PacketRule) -> Column:
    visit = is_code if rule.first_visit else is_not_code
    return (
        _event(rule)
        & visit("visitnum", FIRST_VISIT)
        & is_code(rule.routing_status, VERIFIED)
    )


def _event(rule: PacketRule) -> Column:
    return (is_code if rule.first_visit else is_not_code)(_EVENT, FIRST_EVENT)


def _status(form: str) -> str:
    return f"{form}_complete"
