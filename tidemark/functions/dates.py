"""Date expressions shared by the plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: dt.date | str) -> Column:
    """A date literal from a ``date`` or an ISO string."""
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def month_abbr(day: Column) -> Column:
    return F.date_format(day, "MMM")


def is_monday(day: Column) -> Column:
    return F.dayofweek(day) == 2


def previous_report(day: Column) -> Column:
    """The report before ``day``: none is issued on Sunday's figures, so a
    Monday report looks back two days and any other report one."""
    return F.date_sub(day, F.when(is_monday(day), 2).otherwise(1))


def parse_date(text: Column, fmt: str) -> Column:
    """Text to date; NULL where the text is not a date in ``fmt``."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def to_local(ts: Column, zone: str) -> Column:
    """A UTC timestamp as wall-clock time in ``zone`` (with its DST rules)."""
    return F.from_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")


def from_local(ts: Column, zone: str, twice: str = "first", missing: str = "forward") -> Column:
    """Wall-clock time in ``zone`` as a UTC timestamp.

    A local time that occurs twice (clocks go back) is its ``first`` or its
    ``second`` occurrence. One that never occurs (clocks go forward) moves
    ``forward`` by the hour that was skipped, or is ``null``.
    """
    if twice not in ("first", "second") or missing not in ("forward", "null"):
        raise ValueError("twice must be 'first' or 'second', missing 'forward' or 'null'")
    local = F.unix_micros(ts.cast("timestamp"))
    day = 86_400_000_000

    def shown(utc: Column) -> Column:
        return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(utc), zone))

    # the offset in force a day before and a day after
    before, after = (local - (shown(local + d) - (local + d)) for d in (-day, day))
    first, second = F.least(before, after), F.greatest(before, after)
    choice, other = (first, second) if twice == "first" else (second, first)
    gap = before if missing == "forward" else F.lit(None).cast("long")
    found = F.when(shown(choice) == local, choice).when(shown(other) == local, other).otherwise(gap)
    return F.timestamp_micros(found).cast("timestamp_ntz")


def elapsed_seconds(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))


def month_index(day: Column) -> Column:
    """Running month number; a bucket that holds at most 31 days."""
    return F.year(day) * 12 + F.month(day)
