"""The daily run: reconcile, then each packet. One run date serves all steps.

Steps hand over through written tables, so a lost executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitrec.functions import clean_cell, column, run_date_text
from visitrec.operators import (
    drop_required,
    form_columns,
    keys_first,
    only_in,
    rename_headers,
    sieve,
)
from visitrec.plans.clean import clean_local, clean_registry
from visitrec.plans.packets import (
    BLOCKED,
    READY,
    blocked_records,
    pull_records,
    ready_records,
    route,
    route_all,
    shape_blocked,
    shape_ready,
    verdicts,
)
from visitrec.plans.rules import (
    IDENTIFIERS,
    PACKETS,
    PUSH_LIST_STEM,
    RECORD_COLUMNS,
    REGISTRY_ONLY_STEM,
    VISIT_KEYS,
    PacketRule,
)
from visitrec.sinks import Batch, write_csv, write_text_records
from visitrec.sources import (
    freshness,
    landing_files,
    newest_file,
    read_registry,
)
from visitrec.sources.landing import literal_path
from visitrec.storage import Scratch


@dataclass(frozen=True)
class ReconcileOutput:
    push_list: str
    registry_only: str | None
    stale_input: bool


@dataclass(frozen=True)
class PacketOutput:
    ready: str
    blocked: str
    exported: tuple[str, str] | None = None


#: The registry's headers by ours, and the layout of its text records.
Export = tuple[Mapping[str, str], Sequence[tuple[str, int, str]]]


def run_reconcile(
    spark: SparkSession,
    landing: str,
    local_visits: DataFrame,
    out_root: str,
    run_date: dt.date | str | None = None,
    multi_line: bool | None = None,
) -> ReconcileOutput:
    """Compare the newest registry file with the local visits; write what each side lacks.

    The folder of the run date is replaced as a whole, or left as it was if the run fails.
    """
    scratch = Scratch(spark, "reconcile")
    try:
        with Batch(spark, out_root, run_date_text(run_date)) as batch:
            return _reconcile(spark, landing, local_visits, batch, multi_line, scratch)[0]
    finally:
        scratch.drop()


def _reconcile(
    spark: SparkSession,
    landing: str,
    local_visits: DataFrame,
    batch: Batch,
    multi_line: bool | None,
    scratch: Scratch,
) -> tuple[ReconcileOutput, DataFrame]:
    """The outputs, and the push list as a table of the scratch folder."""
    day = batch.day
    latest = freshness(newest_file(landing_files(spark, landing)), day).first()
    if latest is None:
        raise FileNotFoundError(f"no registry file in {landing}")
    if latest["is_stale"]:
        warnings.warn(
            f"newest registry file is of {latest['file_date']}, not of {day}: {latest['path']}",
            stacklevel=2,
        )

    registry = scratch.keep(
        clean_registry(read_registry(spark, literal_path(latest["path"]), multi_line)), "registry"
    )
    local = scratch.keep(clean_local(local_visits), "local")

    registry_only = only_in(registry, local, VISIT_KEYS).select(*VISIT_KEYS)
    unresolved = batch.csv_if_any(registry_only, f"{REGISTRY_ONLY_STEM}{day}.csv")
    if unresolved:
        warnings.warn(
            f"the registry has visits the local side lacks; resolve them first: {unresolved}",
            stacklevel=2,
        )

    pushed = scratch.keep(
        keys_first(only_in(local, registry, VISIT_KEYS), VISIT_KEYS), "push_list"
    )
    push_list = batch.csv(pushed, f"{PUSH_LIST_STEM}{day}.csv")
    return ReconcileOutput(push_list, unresolved, bool(latest["is_stale"])), pushed


def run_packet(
    records: DataFrame,
    push_list: DataFrame,
    rule: PacketRule,
    dictionary: Mapping[str, Sequence[str]],
    folder: str,
    run_date: dt.date | str,
    export: Export | None = None,
) -> PacketOutput:
    """Write the ready and the blocked records of one packet, and the export if one is described.

    Only the blocked report needs the pull by participant: the ready join is on participant and
    visit number, so it already keeps listed participants alone, and wide rows move once. All packets of a
    day take ``run_day``, which reads the records once for all of them.
    """
    day = run_date_text(run_date)
    routed = route(push_list, rule)
    wide = form_columns(records, rule.pulled, dictionary, RECORD_COLUMNS)
    ready = ready_records(wide, routed, rule)
    blocked = blocked_records(pull_records(records, routed, rule, dictionary), rule)
    scratch = Scratch(records.sparkSession, "packet")
    try:
        if export:
            ready = scratch.keep(ready, "ready")
        return PacketOutput(
            ready=write_csv(ready, f"{folder}/{rule.output_stem}{day}.csv"),
            blocked=write_csv(blocked, f"{folder}/{rule.blocked_stem}{day}.csv"),
            exported=export_text(ready, *export, rule, folder, day) if export else None,
        )
    finally:
        scratch.drop()


def run_day(
    spark: SparkSession,
    landing: str,
    local_visits: DataFrame,
    records: DataFrame,
    dictionary: Mapping[str, Sequence[str]],
    out_root: str,
    run_date: dt.date | str | None = None,
    rules: Sequence[PacketRule] = PACKETS,
    multi_line: bool | None = None,
    exports: Mapping[str, Export] | None = None,
) -> tuple[ReconcileOutput, dict[str, PacketOutput]]:
    """Reconcile, then all packets from the push list; packets named in ``exports`` are exported too.

    The wide records are read once. In that pass a Bloom filter of the routed participants keeps most others from
    moving, the rest meets these participants, all gates of all packets are
    decided as one bit mask, and what has a verdict is stored, without identifiers, in a folder for each packet
    and verdict; a packet's output reads its own folder alone. All outputs of the date are published together.
    """
    day = run_date_text(run_date)
    forms = list(dict.fromkeys(form for rule in rules for form in rule.pulled))
    needed = drop_required(
        form_columns(records, forms, dictionary, RECORD_COLUMNS), IDENTIFIERS
    )
    bare = {form: [f for f in fields if f not in IDENTIFIERS] for form, fields in dictionary.items()}
    marks = {rule.name: f"_routed_{rule.name}" for rule in rules}
    scratch = Scratch(spark, "day")
    try:
        with Batch(spark, out_root, day) as batch:
            reconciled, pushed = _reconcile(spark, landing, local_visits, batch, multi_line, scratch)
            # every cell as the written list would give it back
            push_list = pushed.select(
                *[clean_cell(column(c).cast("string")).alias(c) for c in pushed.columns]
            )
            routed = (
                route_all(push_list, rules)
                .filter("ptid IS NOT NULL")
                .groupBy(F.col("ptid").alias("_routed_ptid"))
                .agg(*[F.bool_or(F.col("packet") == name).alias(mark) for name, mark in marks.items()])
            )
            routed = scratch.keep(routed, "routed")
            ids = routed.select(F.col("_routed_ptid").alias("ptid"))
            needed = sieve(needed, ids, "ptid", ids.count())
            # null-safe for the shuffle's sake: see operators.membership
            met = needed.join(routed, F.col("ptid").eqNullSafe(F.col("_routed_ptid"))).drop("_routed_ptid")
            judged = verdicts(met, rules, {name: F.col(mark) for name, mark in marks.items()})
            judged = scratch.keep_parted(judged.drop(*marks.values()), "judged", ["packet", "verdict"])
            packets = {
                rule.name: _write_packet(
                    judged.filter(F.col("packet") == rule.name),
                    push_list,
                    rule,
                    bare,
                    batch,
                    scratch,
                    (exports or {}).get(rule.name),
                )
                for rule in rules
            }
    finally:
        scratch.drop()
    return reconciled, packets


def _write_packet(
    judged: DataFrame,
    push_list: DataFrame,
    rule: PacketRule,
    dictionary: Mapping[str, Sequence[str]],
    batch: Batch,
    scratch: Scratch,
    export: Export | None,
) -> PacketOutput:
    """The outputs of one packet from the records that have a verdict for it."""
    passed = judged.filter(F.col("verdict") == READY)
    wide = form_columns(passed, rule.pulled, dictionary, RECORD_COLUMNS)
    ready = shape_ready(wide, route(push_list, rule), rule)
    if export:
        ready = scratch.keep(ready, f"ready-{rule.name}")
    stem = f"{rule.output_stem}{batch.day}"
    exported = None
    if export:
        renamed = rename_headers(ready, export[0])
        exported = (
            batch.csv(renamed, f"{stem}_FILTERED.csv"),
            batch.text(renamed, export[1], f"{stem}.txt"),
        )
    return PacketOutput(
        ready=batch.csv(ready, f"{stem}.csv"),
        blocked=batch.csv(
            shape_blocked(judged.filter(F.col("verdict") == BLOCKED), rule),
            f"{rule.blocked_stem}{batch.day}.csv",
        ),
        exported=exported,
    )


def export_text(
    ready: DataFrame,
    header_mapping: Mapping[str, str],
    layout: Sequence[tuple[str, int, str]],
    rule: PacketRule,
    folder: str,
    run_date: dt.date | str,
) -> tuple[str, str]:
    """The ready records under the registry's headers, as CSV and as text records."""
    stem = f"{folder}/{rule.output_stem}{run_date_text(run_date)}"
    renamed = rename_headers(ready, header_mapping)
    return (
        write_csv(renamed, f"{stem}_FILTERED.csv"),
        write_text_records(renamed, layout, f"{stem}.txt"),
    )
