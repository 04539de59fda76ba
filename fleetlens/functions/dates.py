"""Date buckets and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_bucket(c) -> Column:
    return F.to_date(_c(c))


def iso_week_end(c) -> Column:
    """Sunday that ends the ISO week (Monday start + 6 days)."""
    return F.date_add(F.to_date(F.date_trunc("week", _c(c))), 6)


def month_start(c) -> Column:
    return F.trunc(F.to_date(_c(c)), "month")


def day_label(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd")


def minute_label(c) -> Column:
    """``2026-02-28 23:00``, from the timestamp's own text: a wall-clock
    (NTZ) reading prints as stored whatever the session time zone, also
    inside a daylight-saving gap."""
    return F.substring(_c(c).cast("string"), 1, 16)


def month_label(c) -> Column:
    """``JAN-2026``."""
    return F.upper(F.date_format(_c(c), "MMM-yyyy"))


def as_of_literal(as_of) -> Column:
    """``as_of`` as a TIMESTAMP_NTZ literal, built from its text so that no
    time zone (of the Python process or the session) shifts it."""
    text = as_of.isoformat(sep=" ") if hasattr(as_of, "hour") else f"{as_of.isoformat()} 00:00:00"
    return F.lit(text).cast("timestamp_ntz")


def days_before(as_of, days: int) -> Column:
    """The instant ``days`` days before ``as_of`` (not a day boundary)."""
    return as_of_literal(as_of) - F.make_dt_interval(F.lit(days))


def months_back_start(as_of, months: int) -> Column:
    """First day of the month ``months`` months before ``as_of``'s month."""
    return F.add_months(F.trunc(F.to_date(as_of_literal(as_of)), "month"), -months)
