"""Registry, and the derived input tables in check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.months import MONTHS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


CAL = """cal as (
  select d as sales_thru_dt, cast(date_trunc('month', d) as date) as curr_mth_start_dt,
    cast(date_trunc('year', d) as date) as curr_yr_start_dt,
    cast(date_trunc('year', d) - interval 1 year as date) as prior_yr_start_dt,
    cast(d - interval 1 month as date) as prior_mth_current_day_date,
    cast(date_trunc('month', d) - interval 1 day as date) as prior_mth_end_date,
    cast(d - interval 1 year as date) as prior_year_current_day_date, 'US' as iso_ctry_cd
  from (select distinct cast(l_shipdate as date) as d from lineitem) x)"""

_SUMS = ",\n    ".join(
    f"cast(sum(case when month(d.dt)={i} then coalesce(n.n,0) else 0 end) over "
    f'(partition by m.model_nm, year(d.dt) order by d.dt) as int) as "{m}"'
    for i, m in enumerate(MONTHS, start=1)
)

STG = f"""ship_day as (
  select concat('M', cast(l_suppkey % 25 as varchar)) as model_nm, cast(l_shipdate as date) as dt, count(*) as n
  from lineitem group by 1, 2),
stg as (
  select m.model_nm, {_SUMS},
    cast(d.dt + interval 1 day as date) as rpt_dt, d.dt as sales_through_dt
  from (select distinct dt from ship_day) d cross join (select distinct model_nm from ship_day) m
  left join ship_day n on n.dt = d.dt and n.model_nm = m.model_nm)"""

OOS = """oos_base as (
  select concat('V', cast(l_partkey as varchar)) as vin, cast(l_shipdate as date) as outdate,
    cast(l_quantity * 100 as int) as outmile, cast(l_shipdate + interval 7 day as date) as todaydate,
    l_returnflag as outtype, cast(l_linenumber * 10 as int) as daysinservice,
    case when l_linenumber * 10 > 60 then 'Y' else 'N' end as loangreaterthan60 from lineitem),
oos as (
  select * from oos_base union all
  select vin, outdate, outmile, cast(todaydate + interval 14 day as date), outtype, daysinservice, loangreaterthan60
  from oos_base where daysinservice in (10, 40))"""

DEL = """deliv as (
  select concat('V', cast(l_partkey as varchar)) as veh_id_nbr, cast(o_orderdate as date) as orig_proc_dt,
    l_suppkey as biz_assoc_id,
    case l_suppkey % 5 when 0 then 11 when 1 then 12 when 2 then 13 when 3 then 48 else 99 end as sell_src_cd,
    cast(year(o_orderdate) as int) as model_yr, case when l_linestatus = 'F' then 25 else 95 end as kpi_type_cd,
    'US' as ntl_cd, 1 as veh_deliv_cnt, l_linestatus as veh_prod_rpt_model_cd
  from lineitem join orders on l_orderkey = o_orderkey)"""


def month_case(month: str, prefix: str = "") -> str:
    """``case`` that picks a month column by number."""
    whens = " ".join(f'when {i} then {prefix}"{m}"' for i, m in enumerate(MONTHS, start=1))
    return f"(case {month} {whens} end)"


def month_sums(prefix: str = "") -> str:
    return ", ".join(f'sum({prefix}"{m}") as "{m}"' for m in MONTHS)
