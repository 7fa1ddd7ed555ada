"""Dates. Every parser gives null on bad input, also under ANSI mode."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitrec.functions.names import column
from visitrec.functions.text import whole_number

# Fixed value: the run day is counted in UTC-5 all year, without daylight saving.
RUN_ZONE = "-05:00"


def date_from_parts(month: Column, day: Column, year: Column) -> Column:
    """Date from three whole numbers; an impossible date or a missing part gives null.

    Years have four digits, or two: 00 to 68 are of this century, 69 to 99 of the last. The month's length is looked up, so that impossible days cost no
    exception per row.
    """
    m, d, y = (whole_number(part) for part in (month, day, year))
    y = F.when(y.between(0, 68), y + 2000).when(y.between(69, 99), y + 1900).otherwise(y)
    first = F.when(
        y.between(1000, 9999) & m.between(1, 12), F.make_date(y, m, F.lit(1))
    )
    in_month = d.between(F.lit(1), F.dayofmonth(F.last_day(first)))
    return F.when(in_month, F.date_add(first, d - F.lit(1)))


def iso_date(col: Column | str) -> Column:
    """Date from ``yyyy-MM-dd`` text. The cast alone would also take ``2020`` or ``2020-1-1 x``."""
    text = column(col)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text).try_cast("date")


def date_in_zone(ts: Column | str, zone: str = RUN_ZONE) -> Column:
    """Calendar date of a point in time in ``zone``, whatever the session time zone is."""
    return F.convert_timezone(
        F.current_timezone(), F.lit(zone), column(ts).cast("timestamp_ntz")
    ).cast("date")


def default_run_date() -> dt.date:
    """Today in the run zone. Take it once per run and pass it on."""
    return dt.datetime.now(dt.timezone(dt.timedelta(hours=-5))).date()


def run_date_text(run_date: dt.date | str | None = None) -> str:
    """``yyyy-MM-dd`` text of the run date; text is checked, so that paths stay well formed."""
    if run_date is None:
        run_date = default_run_date()
    if isinstance(run_date, str):
        run_date = dt.date.fromisoformat(run_date)
    return run_date.isoformat()
