"""Courtesy-vehicle queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe
from tidemark.operators.joins import not_in
from tidemark.plans import courtesy, inputs
from tidemark.suite.base import DEL, OOS, query

FIRST_YEAR = 1997
AS_OF = dt.date(2001, 12, 31)
DAY = dt.date(2001, 6, 15)
RUN_TS = dt.datetime(2001, 6, 15, 6, 30)


def _ranked(direction: str) -> str:
    cols = ["todaydate", "outtype", "loangreaterthan60"]
    order = ", ".join(f"{c} {direction}" for c in cols)
    return f"row_number() over (partition by vin, outdate, daysinservice, outmile order by {order})"


def _deduped(direction: str) -> str:
    return (
        "select vin, outdate, outmile, todaydate, outtype, daysinservice, loangreaterthan60 "
        f"from (select *, {_ranked(direction)} as rn from oos) x where rn = 1"
    )


@query("dedupe_latest", f"with {OOS} {_deduped('desc')}")
def dedupe_latest(spark, sf_dir):
    return dedupe(inputs.out_of_service(spark, sf_dir), courtesy.NATURAL_KEY, "todaydate", "last")


@query("dedupe_first", f"with {OOS} {_deduped('asc')}")
def dedupe_first(spark, sf_dir):
    return dedupe(inputs.out_of_service(spark, sf_dir), courtesy.NATURAL_KEY, "todaydate", "first")


_DLR = "orig_proc_dt, biz_assoc_id, selling_source, sell_src_cd, veh_prod_rpt_model_cd, model_yr"


def _dealers(name: str, extra: str = "") -> str:
    desc = ", ".join(f"{c} desc" for c in _DLR.split(", "))
    return f"""{name}_in as (
      select veh_id_nbr, orig_proc_dt, biz_assoc_id, model_yr, case sell_src_cd when 11 then 'Buick' when 12 then 'Cadillac'
          when 13 then 'Chevrolet' when 48 then 'GMC' end as selling_source, sell_src_cd, veh_prod_rpt_model_cd
      from deliv where ntl_cd = 'US' and kpi_type_cd in (25, 95) and sell_src_cd in (11, 12, 13, 48)
        and year(orig_proc_dt) >= {FIRST_YEAR} and veh_deliv_cnt = 1 {extra}),
    {name}_first as (select * exclude (rn) from (select *, row_number() over (partition by veh_id_nbr, biz_assoc_id
        order by orig_proc_dt, selling_source, sell_src_cd, veh_prod_rpt_model_cd, model_yr) as rn from {name}_in) x where rn = 1),
    {name} as (select *, row_number() over (partition by veh_id_nbr order by {_DLR}) as in_no,
        row_number() over (partition by veh_id_nbr order by {desc}) as out_no from {name}_first)"""


@query(
    "dealer_sequence",
    f"""with {DEL}, {_dealers('dlr')} select a.veh_id_nbr, a.orig_proc_dt as first_dt, a.biz_assoc_id as first_dealer,
      a.selling_source as first_brand, b.orig_proc_dt as last_dt, b.biz_assoc_id as last_dealer,
      b.selling_source as last_brand
    from dlr a join dlr b on a.veh_id_nbr = b.veh_id_nbr where a.in_no = 1 and b.out_no = 1""",
)
def dealer_sequence(spark, sf_dir):
    seq = courtesy.dealer_sequence(inputs.deliveries(spark, sf_dir), first_year=FIRST_YEAR)
    return seq.select(
        "veh_id_nbr",
        *[
            F.col(f"{end}_dealer.{field}").alias(f"{end}_{name}")
            for end in ("first", "last")
            for field, name in (("orig_proc_dt", "dt"), ("biz_assoc_id", "dealer"), ("selling_source", "brand"))
        ],
    )


_OUT = """o.vin as veh_id_nbr, o.todaydate as file_dt, d.orig_proc_dt as in_svc_dt, o.outdate as out_svc_dt,
  d.biz_assoc_id, o.daysinservice as day_in_svc_cnt, o.outmile as out_svc_mil_cnt, o.outtype as out_svc_type_cd,
  d.selling_source as sell_src_desc, d.sell_src_cd, d.veh_prod_rpt_model_cd, d.model_yr,
  o.loangreaterthan60 as loan_great_than_60_day_cd"""


def _historical(as_of: dt.date) -> str:
    return f"""newest as ({_deduped('desc')}),
    due as (select * from newest where todaydate <= date '{as_of}' - 1),
    inc as (select {_OUT} from due o join dlr d on d.veh_id_nbr = o.vin and d.in_no = 1 where o.outdate > d.orig_proc_dt),
    first_inc as (select * exclude (rn) from (select *, row_number() over (partition by veh_id_nbr order by file_dt,
        in_svc_dt, out_svc_dt, biz_assoc_id, day_in_svc_cnt, out_svc_mil_cnt, out_svc_type_cd, sell_src_desc,
        sell_src_cd, veh_prod_rpt_model_cd, model_yr, loan_great_than_60_day_cd) as rn from inc) x where rn = 1),
    outg as (select {_OUT} from due o join dlr d on d.veh_id_nbr = o.vin and d.out_no = 1 where o.outdate > d.orig_proc_dt),
    hist as (select * from first_inc union
      select * from outg
      where veh_id_nbr || '~' || biz_assoc_id || '~' || file_dt not in
          (select veh_id_nbr || '~' || biz_assoc_id || '~' || file_dt from first_inc)
        and veh_id_nbr || '~' || out_svc_dt || '~' || file_dt not in
          (select veh_id_nbr || '~' || out_svc_dt || '~' || file_dt from first_inc))"""


def _incremental(as_of: dt.date) -> str:
    return f"""oldest as ({_deduped('asc')}),
    incr as (select distinct {_OUT} from oldest o join idlr d on d.veh_id_nbr = o.vin and d.out_no = 1
      where o.todaydate = date '{as_of}' and o.outdate > d.orig_proc_dt)"""


def _idlr(as_of: dt.date) -> str:
    return _dealers("idlr", f"and orig_proc_dt <= date '{as_of}' - 1")


@query("ctp_historical", f"with {OOS}, {DEL}, {_dealers('dlr')}, {_historical(AS_OF)} select * from hist")
def ctp_historical(spark, sf_dir):
    return courtesy.ctp_historical(
        inputs.out_of_service(spark, sf_dir), inputs.deliveries(spark, sf_dir), AS_OF, FIRST_YEAR
    )


@query("ctp_incremental", f"with {OOS}, {DEL}, {_idlr(DAY)}, {_incremental(DAY)} select * from incr")
def ctp_incremental(spark, sf_dir):
    return courtesy.ctp_incremental(
        inputs.out_of_service(spark, sf_dir), inputs.deliveries(spark, sf_dir), DAY, FIRST_YEAR
    )


@query(
    "ctp_combined",
    f"""with {OOS}, {DEL}, {_dealers('dlr')}, {_idlr(DAY)}, {_historical(DAY)}, {_incremental(DAY)},
    both_parts as (select * from hist union all select * from incr)
    select veh_id_nbr as "Veh_Id_Nbr", file_dt as "File_Dt", out_svc_dt as "Out_Svc_Dt", '171749' as "Src_Sys_Id",
      in_svc_dt as "In_Svc_Dt", cast(biz_assoc_id as bigint) as "Biz_Assoc_Id", day_in_svc_cnt as "Day_In_Svc_Cnt",
      out_svc_mil_cnt as "Out_Svc_Mil_Cnt", out_svc_type_cd as "Out_Svc_Type_Cd", sell_src_desc as "Sell_Src_Desc",
      cast(sell_src_cd as int) as "Sell_Src_Cd", veh_prod_rpt_model_cd as "Veh_Prod_Rpt_Model_Cd",
      cast(model_yr as int) as "Model_Yr", loan_great_than_60_day_cd as "Loan_Great_Than_60_Day_Cd",
      veh_id_nbr || '|' || cast(file_dt as varchar) || '|' || cast(out_svc_dt as varchar) || '|171749'
        as "Src_Sys_Uniq_Prim_Key_Val",
      'Veh_Id_Nbr|File_Dt|Out_Svc_Dt|Src_Sys_Id' as "Src_Sys_Uniq_Prim_Key_Col_Val", cast(1 as int) as "Meas_Cnt",
      'N' as "Dw_Anom_Flg", timestamp '{RUN_TS}' as "Dw_Mod_Ts", 'courtesy_kpi' as "Dw_Job_Id", 'I' as "Src_Sys_Iud_Cd"
    from both_parts""",
)
def ctp_combined(spark, sf_dir):
    return courtesy.ctp_combined(
        inputs.out_of_service(spark, sf_dir), inputs.deliveries(spark, sf_dir), DAY, FIRST_YEAR, run_ts=RUN_TS
    )


@query(
    "event_sequence",
    f"""with {OOS}, {DEL}, {_dealers('dlr')}, {_historical(AS_OF)}
    select veh_id_nbr, file_dt, out_svc_dt, row_number() over (partition by veh_id_nbr order by file_dt, in_svc_dt,
      out_svc_dt, biz_assoc_id, day_in_svc_cnt, out_svc_mil_cnt, out_svc_type_cd, sell_src_desc, sell_src_cd,
      veh_prod_rpt_model_cd, model_yr, loan_great_than_60_day_cd) as seq_asc,
      row_number() over (partition by veh_id_nbr order by file_dt desc, in_svc_dt desc,
      out_svc_dt desc, biz_assoc_id desc, day_in_svc_cnt desc, out_svc_mil_cnt desc, out_svc_type_cd desc,
      sell_src_desc desc, sell_src_cd desc, veh_prod_rpt_model_cd desc, model_yr desc,
      loan_great_than_60_day_cd desc) as seq_desc from hist""",
)
def event_sequence(spark, sf_dir):
    hist = ctp_historical(spark, sf_dir)
    return courtesy.event_sequence(hist).select("veh_id_nbr", "file_dt", "out_svc_dt", "seq_asc", "seq_desc")


@query(
    "not_in_null_aware",
    """with probe as (select o_orderkey, case when o_orderstatus <> 'P' then o_custkey end as k1,
        o_orderpriority as k2 from orders),
      listed as (select case when c_acctbal >= 0 then c_custkey end as k1, '1-URGENT' as k2 from customer
        where c_mktsegment <> 'BUILDING')
    select 'plain' as mode, o_orderkey, k1, k2 from probe p where k1 is not null and not exists
      (select 1 from listed l where l.k1 = p.k1 and l.k2 = p.k2)
    union all
    select 'strict', o_orderkey, k1, k2 from probe
      where k1 || '|' || k2 not in (select k1 || '|' || k2 from listed)
    union all
    select 'strict_no_null', o_orderkey, k1, k2 from probe
      where k1 || '|' || k2 not in (select k1 || '|' || k2 from listed where k1 is not null)""",
)
def not_in_null_aware(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    customers = inputs.table(spark, sf_dir, "customer")
    probe = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k1"),
        F.col("o_orderpriority").alias("k2"),
    )
    listed = customers.filter("c_mktsegment <> 'BUILDING'").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("k1"), F.lit("1-URGENT").alias("k2")
    )
    keys = ["k1", "k2"]

    def tagged(mode, df):
        return df.select(F.lit(mode).alias("mode"), *df.columns)

    return (
        tagged("plain", not_in(probe, listed, keys))
        .unionByName(tagged("strict", not_in(probe, listed, keys, strict_null=True)))
        .unionByName(
            tagged("strict_no_null", not_in(probe, listed.filter("k1 is not null"), keys, strict_null=True))
        )
    )
