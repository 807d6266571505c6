"""Shaping helpers and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import elapsed_seconds, from_local, is_monday, month_abbr, parse_date, previous_report, to_local
from tidemark.functions.text import first_word
from tidemark.operators import shape
from tidemark.plans import inputs
from tidemark.suite.base import query


@query(
    "helper_chain",
    """select l_returnflag as flag, status, cast(sum(cents) as bigint) as cents, count(*) as lines from (
      select l_returnflag, l_linestatus as status, cast(round(l_extendedprice * 100) as bigint) as cents from lineitem
      where l_quantity >= 10 and l_discount > 0.01) x group by 1, 2""",
)
def helper_chain(spark, sf_dir):
    df = inputs.table(spark, sf_dir, "lineitem")
    df = shape.filter_rows(df, "l_quantity >= 10")
    df = shape.filter_rows(df, F.col("l_discount") > 0.01)
    df = shape.with_column(df, "cents", "cast(round(l_extendedprice * 100) as bigint)")
    df = shape.rename_column(df, "l_linestatus", "status")
    df = shape.rename_column(df, "no_such_column", "ignored")
    df = shape.drop_column(df, "l_tax")
    df = shape.select_columns(df, "l_returnflag, status , cents")
    df = shape.group_by(df, "l_returnflag, status").agg(F.sum("cents").alias("cents"), F.count("cents").alias("lines"))
    return shape.rename_column(shape.sort_by(df, "l_returnflag, status"), "l_returnflag", "flag")


@query(
    "distinct_years",
    """select distinct cast(date_trunc('year', o_orderdate) as date) as curr_yr_start_dt,
      cast(date_trunc('year', o_orderdate) - interval 1 year as date) as prior_yr_start_dt from orders""",
)
def distinct_years(spark, sf_dir):
    start = F.trunc("o_orderdate", "year")
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.select(start.alias("curr_yr_start_dt"), F.add_months(start, -12).alias("prior_yr_start_dt")).distinct()


@query(
    "predicate_mix",
    """select o_orderkey, o_orderpriority from orders where o_orderstatus <> 'P' and o_totalprice >= 1000 and o_totalprice <= 300000
      and o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW') and o_orderpriority like '%-%H%' and o_orderdate is not null
      and (o_custkey between 10 and 1000 or not o_orderstatus = 'F')""",
)
def predicate_mix(spark, sf_dir):
    c = F.col
    return (
        inputs.table(spark, sf_dir, "orders")
        .filter(
            (c("o_orderstatus") != "P")
            & (c("o_totalprice") >= 1000)
            & (c("o_totalprice") <= 300000)
            & c("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")
            & c("o_orderpriority").like("%-%H%")
            & c("o_orderdate").isNotNull()
            & (c("o_custkey").between(10, 1000) | ~(c("o_orderstatus") == "F"))
        )
        .select("o_orderkey", "o_orderpriority")
    )


@query(
    "date_functions",
    """with d as (select o_orderkey, cast(o_orderdate as date) as d from orders)
    select o_orderkey, cast(month(d) as int) as mth, cast(year(d) as int) as yr, strftime(d, '%b') as mmm, strftime(d, '%a') as eee,
      strftime(d, '%m') as mm, strftime(d, '%Y%m%d') as ymd, d - 1 as day_before, d + 1 as day_after, d as parsed_ymd, d as parsed_mdy,
      case when strftime(d, '%a') = 'Mon' then null else d end as parsed_mixed, strftime(d, '%a') = 'Mon' as monday,
      case when strftime(d, '%a') = 'Mon' then d - 2 else d - 1 end as report_before,
      cast(d - date '1995-01-01' as int) as days_since, cast((d - date '1995-01-01') * 86400 as bigint) as seconds_since from d""",
)
def date_functions(spark, sf_dir):
    d = F.col("d")
    return (
        inputs.table(spark, sf_dir, "orders")
        .select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
        .select(
            "o_orderkey",
            F.month(d).alias("mth"),
            F.year(d).alias("yr"),
            month_abbr(d).alias("mmm"),
            F.date_format(d, "EEE").alias("eee"),
            F.date_format(d, "MM").alias("mm"),
            F.date_format(d, "yyyyMMdd").alias("ymd"),
            F.date_sub(d, 1).alias("day_before"),
            F.date_add(d, 1).alias("day_after"),
            parse_date(F.date_format(d, "yyyyMMdd"), "yyyyMMdd").alias("parsed_ymd"),
            parse_date(F.date_format(d, "MM/dd/yyyy"), "MM/dd/yyyy").alias("parsed_mdy"),
            parse_date(
                F.when(is_monday(d), F.lit("13312023")).otherwise(F.date_format(d, "MMddyyyy")), "MMddyyyy"
            ).alias("parsed_mixed"),
            is_monday(d).alias("monday"),
            previous_report(d).alias("report_before"),
            F.datediff(d, F.lit("1995-01-01").cast("date")).alias("days_since"),
            elapsed_seconds(F.lit("1995-01-01").cast("date"), d).alias("seconds_since"),
        )
    )


@query(
    "string_functions",
    """select c_custkey, c_name || '|' || c_mktsegment as joined, case when c_acctbal >= 0 then c_name || '|' || cast(c_nationkey as varchar) end as null_joined,
      substr(c_name, 1, 8) as head, split_part(c_mktsegment || ' Total', ' ', 1) as first_part, starts_with(c_mktsegment, 'B') as starts_b,
      c_mktsegment like '%U%' as has_u, regexp_extract(c_name, '#0*([1-9]\\d*)', 1) as digits, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as segment,
      case c_nationkey when 11 then 'Buick' when 12 then 'Cadillac' when 13 then 'Chevrolet' end as brand from customer""",
)
def string_functions(spark, sf_dir):
    c = F.col
    rows = inputs.table(spark, sf_dir, "customer").withColumn(
        "given", F.when(c("c_acctbal") >= 0, c("c_nationkey"))
    )
    rows = shape.label_codes(rows, "c_nationkey", {11: "Buick", 12: "Cadillac", 13: "Chevrolet"}, "brand")
    return rows.select(
        "c_custkey",
        shape.concat_key(["c_name", "c_mktsegment"]).alias("joined"),
        shape.concat_key(["c_name", "given"]).alias("null_joined"),
        F.substring("c_name", 1, 8).alias("head"),
        first_word(F.concat("c_mktsegment", F.lit(" Total"))).alias("first_part"),
        c("c_mktsegment").startswith("B").alias("starts_b"),
        c("c_mktsegment").like("%U%").alias("has_u"),
        F.regexp_extract("c_name", r"#0*([1-9]\d*)", 1).alias("digits"),
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("segment"),
        "brand",
    )


@query(
    "tz_convert",
    "select event_id, ts - interval 5 hour as detroit, ts - interval 6 hour as chicago, ts - interval 5 hour as est from events",
)
def tz_convert(spark, sf_dir):
    """UTC event times as local time; all events fall in winter."""
    ts = F.col("ts")
    return inputs.table(spark, sf_dir, "events").select(
        "event_id",
        to_local(ts, "America/Detroit").alias("detroit"),
        to_local(ts, "America/Chicago").alias("chicago"),
        to_local(ts, "-05:00").alias("est"),
    )


# From 1987 to 2006 clocks in the United States went forward on
# the first Sunday of April and back on the last Sunday of October, at 2 a.m.
_CLOCKS = """t as (select o_orderkey, cast(cast(o_orderdate as date) as timestamp) + to_hours(cast(o_orderkey % 4 as bigint))
      + to_minutes(cast(30 * (o_custkey % 2) as bigint)) as happened from orders),
  c as (select *, make_date(cast(year(happened) as bigint), 4, 1) as april, make_date(cast(year(happened) as bigint), 10, 31) as october from t),
  s as (select *, cast(april + cast((7 - dayofweek(april)) % 7 as int) as timestamp) + interval 2 hour as spring,
      cast(october - cast(dayofweek(october) as int) as timestamp) + interval 2 hour as autumn from c)"""


@query(
    "tz_clock_changes",
    f"""with {_CLOCKS} select o_orderkey, happened,
      happened - to_hours(case when happened >= spring + interval 6 hour and happened < autumn + interval 5 hour then 5 else 6 end) as chicago,
      happened - to_hours(7) as phoenix,
      happened + to_hours(case when happened >= spring + interval 1 hour and happened < autumn then 5 else 6 end) as utc_first,
      happened + to_hours(case when happened >= spring + interval 1 hour and happened < autumn - interval 1 hour then 5 else 6 end) as utc_second,
      case when happened < spring or happened >= spring + interval 1 hour
        then happened + to_hours(case when happened >= spring and happened < autumn then 5 else 6 end) end as utc_or_null
    from s""",
)
def tz_clock_changes(spark, sf_dir):
    """Order times of whole years, read as UTC and as Chicago time: both clock
    changes, with hours that occur twice or never."""
    hours = F.col("o_orderkey") % 4 * 60 + F.col("o_custkey") % 2 * 30
    at = F.timestamp_seconds(F.unix_timestamp(F.col("o_orderdate").cast("date").cast("timestamp")) + hours * 60)
    rows = inputs.table(spark, sf_dir, "orders").select("o_orderkey", at.alias("ts"))
    ts = F.col("ts")
    return rows.select(
        "o_orderkey",
        ts.cast("timestamp_ntz").alias("happened"),
        to_local(ts, "America/Chicago").alias("chicago"),
        to_local(ts, "America/Phoenix").alias("phoenix"),
        from_local(ts, "America/Chicago").alias("utc_first"),
        from_local(ts, "America/Chicago", twice="second").alias("utc_second"),
        from_local(ts, "America/Chicago", missing="null").alias("utc_or_null"),
    )
