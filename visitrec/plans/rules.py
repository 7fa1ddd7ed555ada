"""What differs between the packets, as data."""

from __future__ import annotations

from dataclasses import dataclass

# Key columns, event and visit number of the first visit, status code, patterns.
VISIT_KEYS = ("ptid", "form_date", "visitnum")
RECORD_KEYS = ("ptid", "visitnum")
RECORD_COLUMNS = ("ptid", "redcap_event_name", "form_date", "visitnum")
FIRST_EVENT = "visit_1_arm_1"
FIRST_VISIT = "001"
VERIFIED = 2
EVENT_PATTERN = r"visit_\d{1,2}_arm_1"
FORM_VERSION_PATTERN = r"^3\.?[012]?$"
PARTICIPANT_PATTERN = r"^UM\d{8}$"

# Status columns of a visit as a whole, and the fields of the visit pull.
VISIT_STATUSES = ("ivp_z1_complete", "fvp_z1_complete", "tvp_z1_complete", "m1_complete")
VISIT_FIELDS = ("ptid", "redcap_event_name", "form_date", "visitnum", *VISIT_STATUSES)

# Identifying columns that never leave the site.
IDENTIFIERS = (
    "dob",
    "mrn",
    "madc_id",
    "cues_id",
    "tb_id",
    "cues_tbid",
    "paper_visit_num",
)

# File names of the reconcile outputs, before the run date.
REGISTRY_ONLY_STEM = "df_redcap_no_nacc_yes_"
PUSH_LIST_STEM = "df_redcap_yes_nacc_no_"


@dataclass(frozen=True)
class PacketRule:
    """One packet type.

    ``required`` forms must be verified, ``excluded`` forms must be known and not verified. ``shown``
    are the forms in the blocked report; a form may be shown without being tested.
    """

    name: str
    first_visit: bool
    routing_status: str
    pulled: tuple[str, ...]
    required: tuple[str, ...]
    excluded: tuple[str, ...]
    shown: tuple[str, ...]
    checkbox_groups: tuple[str, ...]
    output_stem: str

    @property
    def blocked_stem(self) -> str:
        return f"BLOCKED_{self.output_stem}"


def _forms(prefix: str, codes: str) -> tuple[str, ...]:
    return tuple(f"{prefix}_{code}" for code in codes.split())


_IVP_FORMS = ("header", *_forms("ivp", "a1 a2 a3 a4 a5 b1 b4 b5 b6 b7 b8 b9 c2 d1 d2"))
_FVP_TESTED = ("header", *_forms("fvp", "a1 a2 a3 a4 b1 b4 b5 b6 b7 b8 b9 c2 d1 d2"))
_FVP_FORMS = ("header", *_forms("fvp", "a1 a2 a3 a4 a5 b1 b4 b5 b6 b7 b8 b9 c1 c2 d1 d2"))
_TVP_TESTED = ("header", *_forms("tvp", "t1 a1 a2 a3 a4 b4 b5 b7 b9 d1 d2"))
_TVP_FORMS = ("header", *_forms("tvp", "t1 a1 a2 a3 a4 b4 b5 b7 b9 c2t d1 d2"))

# The forms, checkbox groups and file names of each packet.
# Follow-up pulls also take the first visit's A1 form, which the export step needs.
_TVP_PULLED = ("header", "ivp_a1", *_TVP_FORMS[1:], "tvp_z1")

IVP = PacketRule(
    name="ivp",
    first_visit=True,
    routing_status="ivp_z1_complete",
    pulled=(*_IVP_FORMS, "ivp_z1"),
    required=_IVP_FORMS,
    excluded=(),
    shown=_IVP_FORMS,
    checkbox_groups=("arthtype", "artype"),
    output_stem="NACC_UDS3_ivp_",
)
FVP = PacketRule(
    name="fvp",
    first_visit=False,
    routing_status="fvp_z1_complete",
    pulled=("header", "ivp_a1", *_FVP_FORMS[1:], "fvp_z1"),
    required=_FVP_TESTED,
    excluded=(),
    shown=_FVP_FORMS,
    checkbox_groups=("fu_arthtype", "fu_artype"),
    output_stem="NACC_UDS3_fvp_",
)
TVP = PacketRule(
    name="tvp",
    first_visit=False,
    routing_status="tvp_z1_complete",
    pulled=_TVP_PULLED,
    required=_TVP_TESTED,
    excluded=("tvp_c2t",),
    shown=_TVP_FORMS,
    checkbox_groups=("tele_artype",),
    output_stem="NACC_UDS3_tvp_",
)
TVP_C2 = PacketRule(
    name="tvpc2",
    first_visit=False,
    routing_status="tvp_z1_complete",
    pulled=_TVP_PULLED,
    required=_TVP_FORMS,
    excluded=(),
    shown=_TVP_FORMS,
    checkbox_groups=("tele_artype",),
    output_stem="NACC_UDS3_tvpc2_",
)

PACKETS = (IVP, FVP, TVP, TVP_C2)
