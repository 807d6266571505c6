"""Boundary rules of the fleet sales plans, worked out by hand."""

from __future__ import annotations

import datetime as dt
import pathlib
from functools import reduce

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date, previous_report
from tidemark.functions.months import MONTHS, pick_report_month
from tidemark.operators.carry import asof_join, asof_latest, date_spine, locf, previous
from tidemark.operators.shape import unpivot_months
from tidemark import session
from tidemark.plans import inputs, sales

D = dt.date
SF_DIR = "/root/testdata/sf0.001"


def staging(spark, days):
    """(sales date, {month: value}) to staging rows of one model."""
    data = [("M0", *[v.get(m, 0) for m in MONTHS], d + dt.timedelta(days=1), d) for d, v in days]
    return spark.createDataFrame(
        data, "model_nm string, " + ", ".join(f"{m} int" for m in MONTHS) + ", rpt_dt date, sales_through_dt date"
    )


def calendar(spark, days):
    data = [
        (d, d.replace(day=1), d.replace(month=1, day=1), d.replace(year=d.year - 1, month=1, day=1),
         d, d.replace(day=1) - dt.timedelta(days=1), d.replace(year=d.year - 1), "US")
        for d in days
    ]
    return spark.createDataFrame(
        data,
        "sales_thru_dt date, curr_mth_start_dt date, curr_yr_start_dt date, prior_yr_start_dt date, "
        "prior_mth_current_day_date date, prior_mth_end_date date, prior_year_current_day_date date, iso_ctry_cd string",
    )


def test_previous_report_skips_a_day_on_monday(spark):
    df = spark.createDataFrame([(D(2024, 1, 8),), (D(2024, 1, 9),)], "d date")
    assert [r[0] for r in df.select(previous_report(F.col("d"))).collect()] == [D(2024, 1, 6), D(2024, 1, 8)]


def test_daily_sales_rules(spark):
    # 2024-01-01 is a Monday: its report is dated Tuesday 2024-01-02.
    days = [(D(2023, 12, 31), {"jan": 500, "dec": 90}), (D(2024, 1, 1), {"jan": 4}), (D(2024, 1, 2), {"jan": 9})]
    stg, cal = staging(spark, days), calendar(spark, [d for d, _ in days])
    out = {
        r.sales_thru_dt: r.daily_sales for r in sales.daily_sales(stg, cal, D(2024, 1, 4), since=D(2000, 1, 1)).collect()
    }
    # The year-end January figure counts as zero, so 1 January keeps its 4.
    assert out == {D(2023, 12, 31): None, D(2024, 1, 1): 4, D(2024, 1, 2): 5}


def test_daily_sales_monday_report_looks_back_two_days(spark):
    days = [(D(2024, 2, 9), {"feb": 10}), (D(2024, 2, 10), {"feb": 11}), (D(2024, 2, 11), {"feb": 15})]
    stg, cal = staging(spark, days), calendar(spark, [d for d, _ in days])
    # Sunday 11 February is reported on Monday 12; the join needs the report of
    # Saturday 10, which carries Friday's figures.
    out = {
        r.rpt_dt: r.daily_sales for r in sales.daily_sales(stg, cal, D(2024, 2, 13), since=D(2000, 1, 1)).collect()
    }
    assert out[D(2024, 2, 12)] == 5 and out[D(2024, 2, 11)] == 1


def test_increment_is_the_day_before(spark):
    days = [(D(2024, 2, 6), {"feb": 10}), (D(2024, 2, 7), {"feb": 12})]
    stg, cal = staging(spark, days), calendar(spark, [d for d, _ in days])
    (row,) = sales.daily_sales(stg, cal, D(2024, 2, 8), window="increment").collect()
    assert (row.sales_thru_dt, row.sales_mth_cat, row.daily_sales) == (D(2024, 2, 7), "Feb", 2)


def test_unpivot_equals_twelve_branches(spark):
    stg = staging(spark, [(D(2024, 3, 1), {"jan": 1, "mar": 7}), (D(2024, 4, 1), {"dec": 3})])
    branches = [
        stg.select("rpt_dt", F.lit(i).alias("month_no"), F.lit(m.capitalize()).alias("month"), F.col(m).alias("value"))
        for i, m in enumerate(MONTHS, start=1)
    ]
    assert rows(unpivot_months(stg, ["rpt_dt"])) == rows(reduce(lambda a, b: a.union(b), branches))


def test_first_report_of_a_month_shows_the_closed_month(spark):
    stg = staging(spark, [(D(2024, 1, 1), {"jan": 1, "dec": 99})]).withColumns(
        {"r": as_date("2024-01-01"), "s": as_date("2024-01-01")}
    )
    assert stg.select(pick_report_month(F.col("r"), F.col("s"))).first()[0] == 99


def test_daily_from_cumulative(spark):
    df = spark.createDataFrame(
        [
            (D(2024, 1, 2), 5, D(2024, 1, 1)),
            (D(2024, 1, 3), 8, D(2024, 1, 1)),
            (D(2024, 2, 2), 4, D(2024, 2, 1)),
            (D(2024, 2, 3), 4, D(2024, 2, 1)),
        ],
        "rpt_dt date, mtd int, start date",
    )
    out = sales.daily_from_cumulative(df, [], "rpt_dt", "mtd", "start")
    assert [r.day_sales_cnt for r in out.orderBy("rpt_dt").collect()] == [0, 3, 4, 0]


def test_ytd_percent_change_is_null_for_a_zero_prior_year(spark):
    days = [(D(2023, 3, 5), {}), (D(2024, 3, 5), {"jan": 2, "feb": 3, "mar": 4, "apr": 100})]
    stg, cal = staging(spark, days), calendar(spark, [d for d, _ in days])
    (row,) = sales.ytd_kpis(sales.reported_days(stg, cal), D(2024, 3, 6)).collect()
    assert (row.ytd_sales, row.prior_ytd_sales, row.variance, row.percent_change) == (9, 0, 9, None)


def test_locf_and_lag_match_one_window_over_many_slots(spark):
    data = [("a" if i % 3 else "b", i, None if i % 4 else i * 10) for i in range(200)]
    df = spark.createDataFrame(data, "k string, t int, v int")
    got = rows(locf(df, ["k"], "t", ["v"], F.floor(F.col("t") / 7)))
    want, last = [], {}
    for k, t, v in data:
        last[k] = v if v is not None else last.get(k)
        want.append((k, t, last[k]))
    assert got == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    lagged = {(r.k, r.t): r.p for r in previous(df, ["k"], "t", "v", "p", F.floor(F.col("t") / 7)).collect()}
    before: dict = {}
    for k, t, v in data:
        assert lagged[(k, t)] == before.get(k)
        before[k] = v


def test_asof_join_takes_the_newest_earlier_value(spark):
    left = spark.createDataFrame([("x", 5), ("x", 5), ("x", 0), ("y", 9)], "k string, t int")
    right = spark.createDataFrame([("x", 1, 10), ("x", 5, 50), ("x", 6, 60), ("y", 10, 1)], "k string, t int, v int")
    out = asof_join(left, right, ["k"], "t", "t", "v", lambda t: F.floor(t / 4))
    assert rows(out) == [("x", 0, None), ("x", 5, 50), ("x", 5, 50), ("y", 9, None)]


def test_asof_latest_ignores_nulls_and_later_dates(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), None), (D(2024, 1, 5), 9)], "d date, v int")
    assert asof_latest(df, "d", "v", as_date("2024-01-04")).first()[0] == 1


def test_spine_without_days(spark):
    df = spark.createDataFrame([(D(2024, 1, 3),)], "d date")
    assert date_spine(df, "d", D(2024, 1, 1)).count() == 0
    assert date_spine(df, "d", D(2024, 1, 5)).count() == 3


def test_staging_is_summed_before_any_join(spark):
    """The plan has no cross join, and the two staging reads share one sum."""
    from tidemark.plans import inputs

    sf = "/root/testdata/sf0.001"
    df = sales.daily_sales(inputs.staging(spark, sf), inputs.calendar(spark, sf), D(2001, 11, 6))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_daily_increment_bounds_both_staging_scans(spark, tmp_path):
    inputs.staging(spark, SF_DIR).write.parquet(str(tmp_path / "stg"))
    stg = spark.read.parquet(str(tmp_path / "stg"))
    day = D(1998, 1, 14)
    out = sales.daily_sales(stg, inputs.calendar(spark, SF_DIR), day, "increment", day)
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan parquet" in x and "sales_through_dt" in x]
    assert len(scans) == 2 and all("sales_through_dt#" in x.split("DataFilters")[1].split("Format")[0] and ">=" in x for x in scans)


def test_a_cluster_session_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        session.scratch_dir(Session())


def test_stored_copies_can_be_released(spark):
    path = session.scratch_dir(spark, "x")
    spark.range(3).write.parquet(path)
    made = list(session._MADE)
    session._MADE[:] = [path]
    session.release(spark)
    session._MADE[:] = [p for p in made if p != path]
    assert not pathlib.Path(path).exists()
