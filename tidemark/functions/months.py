"""Column expressions over the twelve month columns of a wide-month table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The month columns of the input.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def month_label(month_no: int) -> str:
    return MONTHS[month_no - 1].capitalize()


def month_array(prefix: str = "") -> Column:
    return F.array(*[F.col(f"{prefix}{m}") for m in MONTHS])


def pick_month(month_no: Column, prefix: str = "") -> Column:
    """The value of the month column numbered ``month_no`` (1-12)."""
    return F.element_at(month_array(prefix), month_no)


def pick_report_month(report_dt: Column, month_start: Column, prefix: str = "") -> Column:
    """Month column of ``month_start``; on the first report of a month the
    column of the month just closed (December before January)."""
    month_no = F.month(month_start)
    closed = F.pmod(month_no - F.lit(2), F.lit(12)) + F.lit(1)
    return pick_month(F.when(report_dt == month_start, closed).otherwise(month_no), prefix)


def sum_to_month(month_no: Column, prefix: str = "") -> Column:
    """January up to ``month_no``, missing months counted as zero."""
    return F.aggregate(
        F.slice(month_array(prefix), F.lit(1), month_no),
        F.lit(0).cast("long"),
        lambda acc, x: acc + F.coalesce(x.cast("long"), F.lit(0).cast("long")),
    )


def zero_january(value: Column, sales_dt: Column, year_starts: list[Column]) -> Column:
    """January counts as zero on the last day before a year starts."""
    boundary = F.lit(False)
    for start in year_starts:
        boundary = boundary | F.coalesce(sales_dt == F.date_sub(start, 1), F.lit(False))
    return F.when(boundary, F.lit(0)).otherwise(value)
