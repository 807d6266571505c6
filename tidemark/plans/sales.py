"""Fleet sales plans: daily, month-to-date and year-to-date figures.

``stg`` is the wide-month staging table (model_nm, jan..dec, rpt_dt,
sales_through_dt); ``cal`` has one row per country and sales date. Every plan
first sums the staging rows per date, with map-side combining, so whatever the
number of models the joins and windows that follow see one row per day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import FLEET_REDUCED_TARGET, FLEET_TARGET
from tidemark.functions.dates import as_date, month_abbr, month_index, previous_report
from tidemark.functions.months import (
    MONTHS,
    pick_month,
    pick_report_month,
    sum_to_month,
    zero_january,
)
from tidemark.operators.carry import asof_latest, date_spine, locf, previous
from tidemark.operators.dedupe import merge_first_nonnull
from tidemark.operators.shape import audit_columns, unpivot_months

FLEET_SOURCE = "171749"
FLEET_REDUCED_SOURCE = "315"
MONTH_KEYS = ["Rpt_Dt", "Sales_Thru_Dt", "Rpt_Mth_Nbr", "Rpt_Mth_Abbr_Txt", "Sales_Mth_Cat", "Sales_Mth_Cat_Nbr"]


def month_totals(stg: DataFrame, by: list[str]) -> DataFrame:
    """Sum of each month column per group."""
    return stg.groupBy(*by).agg(*[F.sum(m).alias(m) for m in MONTHS])


def _daily_totals(stg: DataFrame) -> DataFrame:
    """Month sums per report and sales date. Rows without either date are no
    report; saying so here keeps every use of the sums one shared shuffle."""
    dated = stg.filter(F.col("rpt_dt").isNotNull() & F.col("sales_through_dt").isNotNull())
    return month_totals(dated, ["rpt_dt", "sales_through_dt"])


def _sales_dates(
    cal: DataFrame, as_of: dt.date, window: str, since: dt.date | None, country: str
) -> DataFrame:
    """Calendar rows a run reports on. History ends two days before ``as_of``
    and starts at the prior-year start of that last day, unless ``since`` says
    otherwise; the increment is the day before ``as_of``."""
    rows = cal.filter(F.col("iso_ctry_cd") == country)
    day = F.col("sales_thru_dt")
    if window == "increment":
        rows = rows.filter(day == as_date(as_of - dt.timedelta(days=1)))
    elif window == "history":
        last = as_date(as_of - dt.timedelta(days=2))
        first: Column = as_date(since) if since else rows.filter(day == last).agg(F.max("prior_yr_start_dt")).scalar()
        rows = rows.filter((day <= last) & (day >= first))
    else:
        raise ValueError("window must be 'history' or 'increment'")
    return rows.select(
        "sales_thru_dt",
        "curr_yr_start_dt",
        "prior_yr_start_dt",
        F.month("curr_mth_start_dt").alias("rpt_mth_nbr"),
        month_abbr(F.col("curr_mth_start_dt")).alias("rpt_mth_abbr_txt"),
    )


def daily_sales(
    stg: DataFrame,
    cal: DataFrame,
    as_of: dt.date,
    window: str = "history",
    since: dt.date | None = None,
    country: str = "US",
) -> DataFrame:
    """Sales of one day: the report month's total less its total on the
    report before. NULL where there is no report before.

    The month is picked by number, so the staging table is read for one
    aggregate instead of twelve branches, and the report before is an equality
    on a computed date.
    """
    dates = _sales_dates(cal, as_of, window, since, country)
    # The report dates asked for and the days before bound the staging scan.
    ends = dates.agg(F.min("sales_thru_dt").alias("lo"), F.max("sales_thru_dt").alias("hi"))
    first = ends.select(F.date_sub("lo", 1)).scalar()
    through = F.col("sales_through_dt")
    totals = _daily_totals(stg.filter((through >= first) & (through <= ends.select("hi").scalar())))
    dates = dates.withColumn("_day_before", F.date_sub("sales_thru_dt", 1))
    now = totals.join(dates, F.col("sales_through_dt") == F.col("sales_thru_dt")).select(
        "rpt_dt",
        "sales_thru_dt",
        "rpt_mth_nbr",
        "rpt_mth_abbr_txt",
        pick_month(F.col("rpt_mth_nbr")).alias("_now"),
        previous_report(F.col("rpt_dt")).alias("_before_dt"),
    )
    before = totals.join(dates, F.col("sales_through_dt") == F.col("_day_before")).select(
        F.col("rpt_dt").alias("_before_dt"),
        *[
            (
                zero_january(
                    F.col(m), F.col("sales_through_dt"), [F.col("curr_yr_start_dt"), F.col("prior_yr_start_dt")]
                )
                if m == "jan"
                else F.col(m)
            ).alias(f"_p_{m}")
            for m in MONTHS
        ],
    )
    joined = now.join(before, "_before_dt", "left")
    change = F.col("_now") - pick_month(F.col("rpt_mth_nbr"), "_p_")
    return joined.groupBy("rpt_dt", "sales_thru_dt", "rpt_mth_nbr", "rpt_mth_abbr_txt").agg(
        F.sum(change).alias("daily_sales")
    ).select(
        F.col("rpt_mth_abbr_txt").alias("sales_mth_cat"),
        F.col("rpt_mth_nbr").alias("sales_mth_cat_nbr"),
        "rpt_dt",
        "sales_thru_dt",
        "rpt_mth_nbr",
        "rpt_mth_abbr_txt",
        "daily_sales",
    )


def mtd_all_months(
    stg: DataFrame,
    cal: DataFrame,
    as_of: dt.date,
    window: str = "history",
    since: dt.date | None = None,
    country: str = "US",
) -> DataFrame:
    """Totals of every month up to the report month, one row per month."""
    dates = _sales_dates(cal, as_of, window, since, country)
    totals = _daily_totals(stg)
    joined = totals.join(dates, F.col("sales_through_dt") == F.col("sales_thru_dt"))
    keys = ["rpt_dt", "sales_thru_dt", "rpt_mth_nbr", "rpt_mth_abbr_txt"]
    return unpivot_months(joined, keys, "mtd_sales").filter("month_no <= rpt_mth_nbr").select(
        F.col("month").alias("sales_mth_cat"),
        F.col("month_no").alias("sales_mth_cat_nbr"),
        *keys,
        "mtd_sales",
    )


def foos_cds(
    stg: DataFrame,
    cal: DataFrame,
    as_of: dt.date,
    job_id: str = "fleet_kpi",
    run_ts: dt.datetime | None = None,
    since: dt.date | None = None,
) -> DataFrame:
    """Fleet KPI table: daily and month-to-date sales, history and increment,
    with audit columns in contract order."""
    run_ts = run_ts or dt.datetime.combine(as_of, dt.time())

    def both(plan) -> DataFrame:
        return plan(stg, cal, as_of, "history", since).unionByName(plan(stg, cal, as_of, "increment"))

    joined = both(daily_sales).join(both(mtd_all_months), [k.lower() for k in MONTH_KEYS])
    shaped = joined.select(
        *[F.col(k.lower()).alias(k) for k in MONTH_KEYS],
        F.col("daily_sales").cast("int").alias("Day_Sales_Cnt"),
        F.col("mtd_sales").cast("int").alias("Mth_To_Dt_Sales_Cnt"),
    )
    keys = ["Rpt_Dt", "Sales_Thru_Dt", "Sales_Mth_Cat_Nbr"]
    return FLEET_TARGET.apply(audit_columns(shaped, keys, FLEET_SOURCE, job_id, run_ts))


def mtd_sales(stg: DataFrame, cal: DataFrame) -> DataFrame:
    """Month-to-date total per report date:
    (rpt_dt, curr_mth_start_dt, mtd_sales). The report of a month's first day
    shows the month just closed."""
    totals = month_totals(stg, ["rpt_dt"])
    days = cal.select(F.date_add("sales_thru_dt", 1).alias("rpt_dt"), "curr_mth_start_dt")
    return totals.join(days, "rpt_dt").select(
        "rpt_dt",
        "curr_mth_start_dt",
        pick_report_month(F.col("rpt_dt"), F.col("curr_mth_start_dt")).alias("mtd_sales"),
    )


def daily_from_cumulative(
    df: DataFrame, by: list[str], order: str, value: str, period_start: str, out: str = "day_sales_cnt"
) -> DataFrame:
    """Daily figures from running totals: the total itself on the first day
    of a month (0 in January), else the rise since the row before.

    The figure belongs to the day before ``order``.
    """
    day = F.date_sub(F.col(order), 1)
    start, total = F.col(period_start), F.col(value)
    lagged = previous(df, by, order, value, "_prev", month_index(F.col(order)))
    return lagged.withColumn(
        out,
        F.when((day == start) & (F.month(start) == 1), F.lit(0))
        .when((day == start) | day.isNull(), total)
        .otherwise(total - F.col("_prev")),
    ).drop("_prev")


def daily_from_mtd(
    stg: DataFrame, cal: DataFrame, job_id: str = "fleet_daily", run_ts: dt.datetime | None = None
) -> DataFrame:
    """Reduced fleet KPI table, one row per report date."""
    run_ts = run_ts or dt.datetime(1970, 1, 1)
    daily = daily_from_cumulative(mtd_sales(stg, cal), [], "rpt_dt", "mtd_sales", "curr_mth_start_dt")
    merged = merge_first_nonnull(daily, ["rpt_dt"], ["curr_mth_start_dt"], ["day_sales_cnt", "mtd_sales"])
    shaped = merged.select(
        F.col("rpt_dt").alias("Rpt_Dt"),
        F.date_sub("rpt_dt", 1).alias("Sales_Thru_Dt"),
        F.col("day_sales_cnt").cast("int").alias("Day_Sales_Cnt"),
        F.col("mtd_sales").cast("int").alias("Mth_To_Dt_Sales_Cnt"),
        F.month("rpt_dt").alias("Rpt_Mth_Nbr"),
        month_abbr(F.col("rpt_dt")).alias("Rpt_Mth_Abbr_Txt"),
    )
    audited = audit_columns(shaped, ["Rpt_Dt", "Sales_Thru_Dt"], FLEET_REDUCED_SOURCE, job_id, run_ts)
    return FLEET_REDUCED_TARGET.apply(audited).orderBy(F.desc("Rpt_Dt"))


def date_spine_fill(stg: DataFrame, cal: DataFrame, as_of: dt.date) -> DataFrame:
    """Monthly totals for every date up to ``as_of``; dates without a report
    repeat the last one. Calendar anchors of the sales date are added."""
    totals = month_totals(stg, ["rpt_dt", "sales_through_dt"])
    spine = date_spine(totals, "rpt_dt", as_of, "rpt_dt")
    filled = locf(
        spine.join(totals, "rpt_dt", "left"),
        [],
        "rpt_dt",
        ["sales_through_dt", *MONTHS],
        month_index(F.col("rpt_dt")),
    )
    return _with_anchors(filled, cal)


def reported_days(stg: DataFrame, cal: DataFrame) -> DataFrame:
    """As ``date_spine_fill`` without filling the dates between reports."""
    return _with_anchors(month_totals(stg, ["rpt_dt", "sales_through_dt"]), cal)


def _with_anchors(days: DataFrame, cal: DataFrame) -> DataFrame:
    anchors = cal.select(
        "sales_thru_dt",
        "curr_mth_start_dt",
        "prior_mth_current_day_date",
        "prior_mth_end_date",
        "prior_year_current_day_date",
    )
    return days.join(anchors, F.col("sales_through_dt") == F.col("sales_thru_dt")).drop("sales_thru_dt")


def ytd_kpis(filled: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Per report date: month-to-date, year-to-date, prior year-to-date,
    variance and percent change (NULL when the prior total is 0).

    The prior-year row is the report of the prior-year day plus one; all dates
    are answered by one equality join, not one query each.
    """
    start_no = F.month("curr_mth_start_dt")
    at_start = F.col("sales_through_dt") == F.col("curr_mth_start_dt")
    now = filled.select(
        "rpt_dt",
        F.when(at_start & (start_no == 1), F.lit(0).cast("long")).otherwise(pick_month(start_no)).alias("mtd_sales"),
        sum_to_month(F.month("rpt_dt")).alias("ytd_sales"),
        F.date_add("prior_year_current_day_date", 1).alias("_prior_dt"),
    )
    prior = filled.select(
        F.col("rpt_dt").alias("_prior_dt"), sum_to_month(F.month("rpt_dt")).alias("prior_ytd_sales")
    )
    if as_of:
        now = now.filter(F.col("rpt_dt") == as_date(as_of))
    variance = F.col("ytd_sales") - F.col("prior_ytd_sales")
    return now.join(prior, "_prior_dt", "left").select(
        "rpt_dt",
        "mtd_sales",
        "ytd_sales",
        F.col("_prior_dt").alias("prior_rpt_dt"),
        "prior_ytd_sales",
        variance.alias("variance"),
        F.try_divide(variance, F.col("prior_ytd_sales")).alias("percent_change"),
    )


def daily_total(df: DataFrame, value: str, conditions: dict) -> DataFrame:
    """Sum of ``value`` over the rows that match all ``conditions``."""
    for column, wanted in conditions.items():
        df = df.filter(F.col(column) == F.lit(wanted))
    return df.agg(F.sum(value).alias("daily_total"))


def lookup_value(stg: DataFrame, cal: DataFrame, anchor: str, rpt_dt: dt.date | None = None) -> DataFrame:
    """Calendar anchor of the sales date of each staging row."""
    if rpt_dt:
        stg = stg.filter(F.col("rpt_dt") == as_date(rpt_dt))
    days = cal.select(F.col("sales_thru_dt").alias("sales_through_dt"), anchor)
    return stg.select("rpt_dt", "sales_through_dt").join(days, "sales_through_dt").select("rpt_dt", anchor)


def mtd_asof(stg: DataFrame, cal: DataFrame, requested: dt.date) -> DataFrame:
    """Month-to-date total of the newest report on or before a date. The
    report date itself is looked up in the calendar."""
    totals = month_totals(stg.filter(F.col("rpt_dt") <= as_date(requested)), ["rpt_dt"])
    days = cal.select(F.col("sales_thru_dt").alias("rpt_dt"), "curr_mth_start_dt")
    mtd = totals.join(days, "rpt_dt").select(
        "rpt_dt", pick_month(F.month("curr_mth_start_dt")).alias("mtd_sales")
    )
    return _requested(mtd, requested)


def prior_month_mtd(
    stg: DataFrame, cal: DataFrame, requested: dt.date, anchor: str = "prior_mth_current_day_date"
) -> DataFrame:
    """As ``mtd_asof`` for the month of a prior-month anchor: the same day
    (``prior_mth_current_day_date``) or the end (``prior_mth_end_date``)."""
    totals = month_totals(stg.filter(F.col("rpt_dt") <= as_date(requested)), ["rpt_dt", "sales_through_dt"])
    days = cal.select(F.col("sales_thru_dt").alias("sales_through_dt"), anchor)
    mtd = (
        totals.join(days, "sales_through_dt")
        .groupBy("rpt_dt")
        .agg(F.sum(pick_month(F.month(anchor))).alias("mtd_sales"))
    )
    return _requested(mtd, requested)


def _requested(mtd: DataFrame, requested: dt.date) -> DataFrame:
    newest = asof_latest(mtd, "rpt_dt", "mtd_sales", as_date(requested))
    return newest.filter("mtd_sales is not null").select(
        as_date(requested).alias("requested_rpt_dt"), "mtd_sales"
    )
