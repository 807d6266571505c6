"""Fleet sales queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.dates import month_index
from tidemark.functions.months import MONTHS
from tidemark.operators.carry import asof_join
from tidemark.operators.dedupe import merge_first_nonnull
from tidemark.plans import inputs, sales
from tidemark.suite.base import CAL, STG, month_case, month_sums, query

# The first date after the last sales date of the tables.
AS_OF = dt.date(2001, 11, 6)
FIRST = dt.date(1990, 1, 1)
RUN_TS = dt.datetime(2001, 11, 6, 6, 30)
REQUESTED = dt.date(2000, 3, 11)
SPINE_END = dt.date(2001, 11, 10)


def _inputs(spark, sf_dir):
    return inputs.staging(spark, sf_dir), inputs.calendar(spark, sf_dir)


def _no_monday_reports(spark, sf_dir):
    stg, cal = _inputs(spark, sf_dir)
    return stg.filter(F.dayofweek("rpt_dt") != 2), cal


def _daily_branches(window: str) -> str:
    """The daily figure written the long way: one branch per month."""
    branches = " union ".join(
        f"""select '{m.capitalize()}' as sales_mth_cat, {i} as sales_mth_cat_nbr, f.rpt_dt, f.sales_thru_dt,
          f.rpt_mth_nbr, f.rpt_mth_abbr_txt, cast(sum(f."{m}" - p."{m}") as bigint) as daily_sales
        from {window}_curr f left join {window}_prev p on
          (strftime(f.rpt_dt, '%a') = 'Mon' and p.rpt_dt = f.rpt_dt - 2)
          or (strftime(f.rpt_dt, '%a') <> 'Mon' and p.rpt_dt = f.rpt_dt - 1)
        where f.rpt_mth_nbr = {i} group by all"""
        for i, m in enumerate(MONTHS, start=1)
    )
    rest = ", ".join(f'sum(s."{m}") as "{m}"' for m in MONTHS[1:])
    keys = "s.rpt_dt, t.sales_thru_dt, t.rpt_mth_nbr, t.rpt_mth_abbr_txt"
    return f"""{window}_prev as (
      select {keys}, sum(case when s.sales_through_dt = t.curr_yr_start_dt - 1 then 0
        when s.sales_through_dt = t.prior_yr_start_dt - 1 then 0 else s."jan" end) as "jan", {rest}
      from stg s, {window}_thru t where s.sales_through_dt = t.sales_thru_dt - 1 group by all),
    {window}_curr as (select {keys}, {month_sums('s.')}
      from stg s, {window}_thru t where s.sales_through_dt = t.sales_thru_dt group by all),
    {window}_daily as ({branches})"""


def _thru(window: str, where: str) -> str:
    return f"""{window}_thru as (
      select sales_thru_dt, curr_yr_start_dt, prior_yr_start_dt, cast(month(curr_mth_start_dt) as int) as rpt_mth_nbr,
        strftime(curr_mth_start_dt, '%b') as rpt_mth_abbr_txt
      from cal where iso_ctry_cd = 'US' and {where})"""


def _mtd_branches(window: str) -> str:
    branches = " union ".join(
        f"""select '{m.capitalize()}' as sales_mth_cat, {i} as sales_mth_cat_nbr, s.rpt_dt, t.sales_thru_dt,
          t.rpt_mth_nbr, t.rpt_mth_abbr_txt, cast(sum(s."{m}") as bigint) as mtd_sales
        from stg s, {window}_thru t where s.sales_through_dt = t.sales_thru_dt and {i} <= t.rpt_mth_nbr group by all"""
        for i, m in enumerate(MONTHS, start=1)
    )
    return f"{window}_mtd as ({branches})"


_ALL_HISTORY = f"sales_thru_dt <= date '{AS_OF}' - 2"
_RANGE = (
    f"sales_thru_dt <= date '{AS_OF}' - 2 and sales_thru_dt >= "
    f"(select max(prior_yr_start_dt) from cal where iso_ctry_cd = 'US' and sales_thru_dt = date '{AS_OF}' - 2)"
)


@query(
    "daily_sales",
    f"with {CAL}, {STG}, {_thru('h', _ALL_HISTORY)}, {_daily_branches('h')} select * from h_daily",
)
def daily_sales(spark, sf_dir):
    stg, cal = _inputs(spark, sf_dir)
    return sales.daily_sales(stg, cal, AS_OF, since=FIRST)


@query(
    "mtd_all_months",
    f"with {CAL}, {STG}, {_thru('h', _ALL_HISTORY)}, {_mtd_branches('h')} select * from h_mtd",
)
def mtd_all_months(spark, sf_dir):
    stg, cal = _inputs(spark, sf_dir)
    return sales.mtd_all_months(stg, cal, AS_OF, since=FIRST)


@query(
    "foos_cds",
    f"""with {CAL}, {STG}, {_thru('h', _RANGE)}, {_thru('i', f"sales_thru_dt = date '{AS_OF}' - 1")},
    {_daily_branches('h')}, {_daily_branches('i')}, {_mtd_branches('h')}, {_mtd_branches('i')},
    d as (select * from h_daily union all select * from i_daily),
    m as (select * from h_mtd union all select * from i_mtd)
    select rpt_dt as "Rpt_Dt", sales_thru_dt as "Sales_Thru_Dt", cast(sales_mth_cat_nbr as int) as "Sales_Mth_Cat_Nbr",
      '171749' as "Src_Sys_Id", sales_mth_cat as "Sales_Mth_Cat", cast(daily_sales as int) as "Day_Sales_Cnt",
      cast(mtd_sales as int) as "Mth_To_Dt_Sales_Cnt", cast(rpt_mth_nbr as int) as "Rpt_Mth_Nbr",
      rpt_mth_abbr_txt as "Rpt_Mth_Abbr_Txt",
      cast(rpt_dt as varchar) || '|' || cast(sales_thru_dt as varchar) || '|' || cast(sales_mth_cat_nbr as varchar)
        || '|171749' as "Src_Sys_Uniq_Prim_Key_Val",
      'Rpt_Dt|Sales_Thru_Dt|Sales_Mth_Cat_Nbr|Src_Sys_Id' as "Src_Sys_Uniq_Prim_Key_Col_Val",
      cast(1 as int) as "Meas_Cnt", 'N' as "Dw_Anom_Flg", timestamp '{RUN_TS}' as "Dw_Mod_Ts",
      'fleet_kpi' as "Dw_Job_Id", 'I' as "Src_Sys_Iud_Cd"
    from d join m using (rpt_dt, sales_thru_dt, rpt_mth_nbr, rpt_mth_abbr_txt, sales_mth_cat, sales_mth_cat_nbr)""",
)
def foos_cds(spark, sf_dir):
    stg, cal = _inputs(spark, sf_dir)
    return sales.foos_cds(stg, cal, AS_OF, run_ts=RUN_TS)


_BIG_SUMS = ", ".join(f'cast(sum("{m}") as bigint) as "{m}"' for m in MONTHS)


@query(
    "month_totals",
    f"with {STG} select rpt_dt, sales_through_dt, {_BIG_SUMS} from stg group by rpt_dt, sales_through_dt",
)
def month_totals(spark, sf_dir):
    return sales.month_totals(inputs.staging(spark, sf_dir), ["rpt_dt", "sales_through_dt"])


_MTD = f"""tot as (select rpt_dt, {month_sums()} from stg group by rpt_dt),
  mtd as (select t.rpt_dt, c.curr_mth_start_dt, cast(case when t.rpt_dt = c.curr_mth_start_dt
      then {month_case("(case when month(c.curr_mth_start_dt) = 1 then 12 else month(c.curr_mth_start_dt) - 1 end)", "t.")}
      else {month_case("month(c.curr_mth_start_dt)", "t.")} end as bigint) as mtd_sales
    from tot t join cal c on t.rpt_dt - 1 = c.sales_thru_dt)"""


@query("mtd_sales", f"with {CAL}, {STG}, {_MTD} select * from mtd")
def mtd_sales(spark, sf_dir):
    return sales.mtd_sales(*_inputs(spark, sf_dir))


@query(
    "daily_from_mtd",
    f"""with {CAL}, {STG}, {_MTD},
    lagged as (select *, lag(mtd_sales) over (order by rpt_dt) as prev from mtd)
    select rpt_dt as "Rpt_Dt", rpt_dt - 1 as "Sales_Thru_Dt", '315' as "Src_Sys_Id",
      cast(case when rpt_dt - 1 = curr_mth_start_dt and month(curr_mth_start_dt) = 1 then 0
        when rpt_dt - 1 = curr_mth_start_dt then mtd_sales else mtd_sales - prev end as int) as "Day_Sales_Cnt",
      cast(mtd_sales as int) as "Mth_To_Dt_Sales_Cnt", cast(month(rpt_dt) as int) as "Rpt_Mth_Nbr",
      strftime(rpt_dt, '%b') as "Rpt_Mth_Abbr_Txt",
      cast(rpt_dt as varchar) || '|' || cast(rpt_dt - 1 as varchar) || '|315' as "Src_Sys_Uniq_Prim_Key_Val",
      'Rpt_Dt|Sales_Thru_Dt|Src_Sys_Id' as "Src_Sys_Uniq_Prim_Key_Col_Val", cast(1 as int) as "Meas_Cnt",
      'N' as "Dw_Anom_Flg", timestamp '{RUN_TS}' as "Dw_Mod_Ts", 'fleet_daily' as "Dw_Job_Id", 'I' as "Src_Sys_Iud_Cd"
    from lagged""",
)
def daily_from_mtd(spark, sf_dir):
    return sales.daily_from_mtd(*_inputs(spark, sf_dir), run_ts=RUN_TS)


@query(
    "daily_by_model",
    f"""with {CAL}, {STG},
    picked as (select s.model_nm, s.rpt_dt, c.curr_mth_start_dt,
        cast({month_case("month(c.curr_mth_start_dt)", "s.")} as bigint) as mtd
      from stg s join cal c on s.sales_through_dt = c.sales_thru_dt),
    lagged as (select *, lag(mtd) over (partition by model_nm order by rpt_dt) as prev from picked)
    select model_nm, rpt_dt, mtd, cast(case when rpt_dt - 1 = curr_mth_start_dt and month(curr_mth_start_dt) = 1 then 0
        when rpt_dt - 1 = curr_mth_start_dt then mtd else mtd - prev end as bigint) as day_sales_cnt
    from lagged""",
)
def daily_by_model(spark, sf_dir):
    stg, cal = _inputs(spark, sf_dir)
    from tidemark.functions.months import pick_month

    days = cal.select(F.col("sales_thru_dt").alias("sales_through_dt"), "curr_mth_start_dt")
    picked = stg.join(days, "sales_through_dt").select(
        "model_nm",
        "rpt_dt",
        "curr_mth_start_dt",
        pick_month(F.month("curr_mth_start_dt")).cast("long").alias("mtd"),
    )
    daily = sales.daily_from_cumulative(picked, ["model_nm"], "rpt_dt", "mtd", "curr_mth_start_dt")
    return daily.drop("curr_mth_start_dt")


_FILLED_COLS = ", ".join(
    f'last_value("{m}" ignore nulls) over w as "{m}"' for m in MONTHS
)
_EVERY = f"""rep as (select rpt_dt, sales_through_dt, {_BIG_SUMS} from stg group by rpt_dt, sales_through_dt),
  spine as (select cast(unnest(generate_series((select min(rpt_dt) from rep), date '{SPINE_END}', interval 1 day)) as date) as day),
  carried as (select spine.day as rpt_dt, last_value(sales_through_dt ignore nulls) over w as sales_through_dt, {_FILLED_COLS}
    from spine left join rep on rep.rpt_dt = spine.day
    window w as (order by spine.day rows between unbounded preceding and current row)),
  filled as (select carried.*, cal.curr_mth_start_dt, cal.prior_mth_current_day_date, cal.prior_mth_end_date,
      cal.prior_year_current_day_date
    from carried join cal on carried.sales_through_dt = cal.sales_thru_dt)"""
_FILLED = _EVERY.replace(" from stg group by", " from stg where strftime(rpt_dt, '%a') <> 'Mon' group by")


@query("date_spine_fill", f"with {CAL}, {STG}, {_FILLED} select * from filled")
def date_spine_fill(spark, sf_dir):
    stg, cal = _no_monday_reports(spark, sf_dir)
    return sales.date_spine_fill(stg, cal, SPINE_END)


def _to_month(month: str) -> str:
    parts = " + ".join(
        f'(case when {i} <= {month} then coalesce("{m}", 0) else 0 end)' for i, m in enumerate(MONTHS, start=1)
    )
    return f"cast({parts} as bigint)"


@query(
    "ytd_kpis",
    f"""with {CAL}, {STG}, {_EVERY},
    y as (select rpt_dt, cast(case when sales_through_dt = curr_mth_start_dt and month(curr_mth_start_dt) = 1 then 0
        else {month_case('month(curr_mth_start_dt)')} end as bigint) as mtd_sales,
        {_to_month('month(rpt_dt)')} as ytd_sales, prior_year_current_day_date + 1 as prior_rpt_dt from filled)
    select a.rpt_dt, a.mtd_sales, a.ytd_sales, a.prior_rpt_dt, b.ytd_sales as prior_ytd_sales,
      a.ytd_sales - b.ytd_sales as variance,
      round((a.ytd_sales - b.ytd_sales) / cast(nullif(b.ytd_sales, 0) as double), 9) as percent_change
    from y a left join y b on b.rpt_dt = a.prior_rpt_dt""",
)
def ytd_kpis(spark, sf_dir):
    stg, cal = _inputs(spark, sf_dir)
    kpis = sales.ytd_kpis(sales.date_spine_fill(stg, cal, SPINE_END))
    return kpis.withColumn("percent_change", F.round("percent_change", 9))


@query(
    "daily_total",
    """with ship_day as (select concat('M', cast(l_suppkey % 25 as varchar)) as model_nm,
      cast(l_shipdate as date) + 1 as rpt_dt, count(*) as daily_sales_cnt from lineitem group by 1, 2)
    select cast(sum(daily_sales_cnt) as bigint) as daily_total from ship_day
    where model_nm = 'M7' and rpt_dt = date '2000-03-11'""",
)
def daily_total(spark, sf_dir):
    days = inputs.ship_days(spark, sf_dir).select(
        "model_nm", F.date_add("dt", 1).alias("rpt_dt"), F.col("n").alias("daily_sales_cnt")
    )
    return sales.daily_total(days, "daily_sales_cnt", {"model_nm": "M7", "rpt_dt": REQUESTED})


@query(
    "lookup_value",
    f"""with {CAL}, {STG} select s.rpt_dt, c.prior_mth_end_date
    from stg s join cal c on s.sales_through_dt = c.sales_thru_dt""",
)
def lookup_value(spark, sf_dir):
    return sales.lookup_value(*_inputs(spark, sf_dir), anchor="prior_mth_end_date")


def _latest(inner: str) -> str:
    return f"""select date '{REQUESTED}' as requested_rpt_dt, cast(mtd_sales as bigint) as mtd_sales from ({inner}) x
    where rpt_dt <= date '{REQUESTED}' and mtd_sales is not null order by rpt_dt desc limit 1"""


@query(
    "mtd_asof",
    f"with {CAL}, {STG} "
    + _latest(
        f"""select rpt_dt, {month_case('month(curr_mth_start_dt)')} as mtd_sales from (
        select s.rpt_dt, c.curr_mth_start_dt, {month_sums('s.')} from stg s join cal c on s.rpt_dt = c.sales_thru_dt
        group by 1, 2) t"""
    ),
)
def mtd_asof(spark, sf_dir):
    return sales.mtd_asof(*_inputs(spark, sf_dir), REQUESTED)


def _prior(anchor: str) -> str:
    return _latest(
        f"""select rpt_dt, sum({month_case(f'month({anchor})')}) as mtd_sales from (
        select s.rpt_dt, c.{anchor}, {month_sums('s.')} from stg s join cal c on s.sales_through_dt = c.sales_thru_dt
        group by 1, 2) t group by rpt_dt"""
    )


@query("prior_month_mtd", f"with {CAL}, {STG} " + _prior("prior_mth_current_day_date"))
def prior_month_mtd(spark, sf_dir):
    return sales.prior_month_mtd(*_inputs(spark, sf_dir), REQUESTED)


@query("prior_month_end", f"with {CAL}, {STG} " + _prior("prior_mth_end_date"))
def prior_month_end(spark, sf_dir):
    return sales.prior_month_mtd(*_inputs(spark, sf_dir), REQUESTED, "prior_mth_end_date")


@query(
    "asof_join",
    """with prices as (select o_custkey, cast(o_orderdate as date) as price_dt,
        max(cast(o_totalprice as decimal(18,2))) as price from orders group by 1, 2),
      asked as (select o_orderkey, o_custkey, cast(o_orderdate as date) - 30 as ask_dt from orders)
    select a.o_orderkey, a.o_custkey, a.ask_dt, p.price from asked a asof left join prices p
      on a.o_custkey = p.o_custkey and a.ask_dt >= p.price_dt""",
)
def asof_orders(spark, sf_dir):
    """The newest order value of the customer 30 days before each order."""
    orders = inputs.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    asked = orders.select("o_orderkey", "o_custkey", F.date_sub(day, 30).alias("ask_dt"))
    prices = orders.select(
        "o_custkey", day.alias("price_dt"), F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    return asof_join(asked, prices, ["o_custkey"], "ask_dt", "price_dt", "price", month_index)


@query(
    "merge_first_nonnull",
    """select o_custkey,
      arg_min(o_orderpriority, (o_orderdate, o_orderkey)) filter (where o_orderstatus = 'F') as first_closed_priority,
      arg_min(o_orderstatus, (o_orderdate, o_orderkey)) as first_status
    from orders group by o_custkey""",
)
def first_values(spark, sf_dir):
    """Per customer, the first order status and the priority of the first
    closed order."""
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderdate",
        "o_orderkey",
        F.col("o_orderstatus").alias("first_status"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("first_closed_priority"),
    )
    return merge_first_nonnull(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["first_closed_priority", "first_status"]
    )


@query(
    "sql_source",
    """select c_mktsegment, cast(count(*) as bigint) as orders_until from orders join customer on o_custkey = c_custkey
    where cast(o_orderdate as date) <= date '2000-03-11' group by 1""",
)
def sql_source(spark, sf_dir):
    """SQL text with a named date argument over registered views."""
    from tidemark.sources.readers import query as run_sql
    from tidemark.sources.readers import register_views

    register_views(spark, {f"v_{t}": inputs.table(spark, sf_dir, t) for t in ("orders", "customer")})
    return run_sql(
        spark,
        """select c_mktsegment, count(*) as orders_until from v_orders join v_customer on o_custkey = c_custkey
        where cast(o_orderdate as date) <= :as_of group by 1""",
        as_of=REQUESTED,
    )
