"""Dates of domains and formatted times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_date(dates: Column) -> Column:
    """The first of several dates, null for none."""
    return F.get(dates, F.lit(0))


def as_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def age_days(created: Column, now: Column) -> Column:
    """Whole days between two times, never negative (days of 24 hours, not calendar days)."""
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(created.cast("timestamp"))
    return F.greatest(F.floor(micros / F.lit(86_400_000_000)), F.lit(0)).cast("int")


def legacy_age(text: Column) -> Column:
    """The day count of texts like ``2.5 years (897 days)``."""
    return F.regexp_extract(text, r"\((\d+) days\)", 1).try_cast("int")


def duration(seconds: Column) -> Column:
    """``1h 0m 5s``: hours only where there are any, then minutes always."""
    s = F.round(seconds).cast("bigint")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.concat_ws(
        " ",
        F.when(h > 0, F.concat(h.cast("string"), F.lit("h"))),
        F.when((m > 0) | (h > 0), F.concat(m.cast("string"), F.lit("m"))),
        F.concat((s % 60).cast("string"), F.lit("s")),
    )
