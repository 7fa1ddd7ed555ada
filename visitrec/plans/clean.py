"""Both sides of the reconciliation, cleaned to the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitrec.functions import date_from_parts, iso_date, matches
from visitrec.operators import any_complete, integers_by_suffix
from visitrec.plans.rules import (
    FORM_VERSION_PATTERN,
    PARTICIPANT_PATTERN,
    VERIFIED,
    VISIT_STATUSES,
)


def clean_registry(
    visits: DataFrame, version_pattern: str = FORM_VERSION_PATTERN
) -> DataFrame:
    """``ptid, form_date, visitnum`` of the records of the current form version.

    A record with an impossible date stays, without a date.
    """
    return visits.filter(matches("FORMVER", version_pattern)).select(
        F.col("PTID").alias("ptid"),
        date_from_parts(F.col("VISITMO"), F.col("VISITDAY"), F.col("VISITYR")).alias(
            "form_date"
        ),
        F.col("VISITNUM").alias("visitnum"),
    )


def clean_local(
    visits: DataFrame, participant_pattern: str = PARTICIPANT_PATTERN
) -> DataFrame:
    """Visits of real participants that have a date and at least one complete visit status."""
    dated = (
        visits.filter(matches("ptid", participant_pattern))
        .withColumn("form_date", iso_date("form_date"))
        .filter(F.col("form_date").isNotNull())
    )
    return any_complete(integers_by_suffix(dated), VISIT_STATUSES, VERIFIED)
