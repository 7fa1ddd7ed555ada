"""The packet rules and the two jobs: reconcile, and process one packet."""

from visitrec.plans.clean import clean_local, clean_registry
from visitrec.plans.daily import export_text, run_day, run_packet, run_reconcile
from visitrec.plans.packets import (
    blocked_records,
    pull_records,
    ready_records,
    route,
    route_all,
    verdict_mask,
    verdicts,
)
from visitrec.plans.rules import FVP, IVP, PACKETS, TVP, TVP_C2, VISIT_KEYS, PacketRule

__all__ = [
    "FVP",
    "IVP",
    "PACKETS",
    "PacketRule",
    "TVP",
    "TVP_C2",
    "VISIT_KEYS",
    "blocked_records",
    "clean_local",
    "clean_registry",
    "export_text",
    "pull_records",
    "ready_records",
    "route",
    "route_all",
    "run_day",
    "run_packet",
    "run_reconcile",
    "verdict_mask",
    "verdicts",
]
