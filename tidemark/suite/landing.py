"""Landing files, incremental loads and dimensions."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import OBJECTIVE_LAYOUTS, TableContract, layout_from_ranges
from tidemark.functions.months import MONTHS
from tidemark.operators.dedupe import drop_exact_duplicates
from tidemark.operators.quality import contract_violations
from tidemark.plans import inputs, landing
from tidemark.session import scratch_dir
from tidemark.sinks.ledger import LEDGER, claim_new_files, missing_arrivals, record_processed
from tidemark.sinks.writers import (
    append_if_absent,
    existing,
    stage_then_load,
    verify_copies,
)
from tidemark.sources.dimensions import dimension_from_nested, store_dimension
from tidemark.sources.listing import latest_by_name_date, list_files, match_pattern, store_listing, stored_listing, valid_files
from tidemark.sources.readers import header_dated_lines, load, read_fixed_width, read_lines, text_schema
from tidemark.suite.base import OOS, STG, query

CUT = dt.date(1999, 1, 1)
LAST_FOLDER = r"/f=([^/]+)/[^/]+$"


def _wide_month_files(spark, sf_dir) -> str:
    """One file per report day, with a line per model."""
    rows = inputs.staging(spark, sf_dir).select(
        F.concat(F.lit("MODEL_NET_"), F.date_format("rpt_dt", "yyyyMMdd"), F.lit(".txt")).alias("f"),
        F.concat_ws("~", "model_nm", *MONTHS).alias("value"),
    )
    return inputs.write_by_name(rows, scratch_dir(spark, "landing"))


@query(
    "stage_wide_month",
    f"""with {STG} select model_nm, {', '.join(f'"{m}"' for m in MONTHS)}, rpt_dt, sales_through_dt from stg""",
)
def stage_wide_month(spark, sf_dir):
    return landing.stage_wide_month(spark, _wide_month_files(spark, sf_dir))


@query(
    "stage_out_of_service",
    f"""with {OOS} select vin, outdate, outmile, case when outtype = 'N' then null else todaydate end as todaydate,
      outtype, case when outtype = 'R' then null else daysinservice end as daysinservice, loangreaterthan60 from oos""",
)
def stage_out_of_service(spark, sf_dir):
    """Text that is not a number or a date gives NULL."""
    path = scratch_dir(spark, "landing")
    inputs.out_of_service(spark, sf_dir).select(
        F.concat_ws(
            "|",
            "vin",
            F.date_format("outdate", "MM/dd/yyyy"),
            F.col("outmile").cast("string"),
            F.when(F.col("outtype") == "N", "13/31/2023").otherwise(F.date_format("todaydate", "MM/dd/yyyy")),
            "outtype",
            F.when(F.col("outtype") == "R", "n/a").otherwise(F.col("daysinservice").cast("string")),
            "loangreaterthan60",
        ).alias("value")
    ).write.text(path)
    return landing.stage_out_of_service(spark, path)


_SUPPLY_DAY = dt.date(2000, 1, 1)


@query(
    "ingest_for_date",
    f"""select s_name as supplier_name, l_returnflag as produce_type, cast(cast(sum(l_quantity) as bigint) as varchar) as quantity,
      '{_SUPPLY_DAY}' as today_date, n_name as state
    from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
    where year(l_shipdate) = {_SUPPLY_DAY.year} group by 1, 2, n_name""",
)
def ingest_for_date(spark, sf_dir):
    """Yearly supply files per state; only those of one date are read."""
    names = inputs.table(spark, sf_dir, "supplier").join(
        inputs.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    # Sum per supplier before names are joined on, so few rows are shuffled.
    supplied = (
        inputs.table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.trunc("l_shipdate", "year").alias("day"), F.col("l_returnflag").alias("produce_type"))
        .agg(F.sum("l_quantity").cast("long").alias("quantity"))
        .join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    folder = scratch_dir(spark, "supply")
    rows = supplied.select(
        F.concat("n_name", F.lit("_grocery_supply_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv")).alias("f"),
        F.col("s_name").alias("supplier_name"),
        "produce_type",
        "quantity",
        F.date_format("day", "yyyy-MM-dd").alias("today_date"),
    )
    inputs.write_by_name(rows, folder, "csv", header="true")
    return landing.ingest_for_date(spark, folder, _SUPPLY_DAY).drop("file_path")


_OBJ = """obj as (
  select l_suppkey as dealer, case l_suppkey % 5 when 0 then '11' when 1 then '12' when 2 then '13' when 3 then '48' else '99' end as code,
    cast(date_trunc('month', l_shipdate) as date) as month_start, count(*) as n from lineitem group by 1, 2, 3)"""


def _bac_line():
    return F.concat(
        F.lit("OBJ  "),
        F.lpad(F.col("dealer").cast("string"), 6, "0"),
        F.col("code"),
        F.col("brand"),
        F.col("day_text"),
        F.lpad(F.col("n").cast("string"), 7, "0"),
    )


def _objective_files(spark, sf_dir) -> str:
    """One file per month: a header with the date, then BAC records."""
    rows = inputs.objectives(spark, sf_dir)
    name = F.concat(F.lit("OBJ_BAC_"), F.date_format("month_start", "yyyyMMdd"), F.lit(".txt")).alias("f")
    head = rows.select("month_start").distinct().select(
        name, F.concat(F.lit("HDR  BAC"), F.date_format("month_start", "MM/dd/yyyy")).alias("value")
    )
    return inputs.write_by_name(head.unionByName(rows.select(name, _bac_line().alias("value"))), scratch_dir(spark, "obj"))


@query(
    "fixed_width_objectives",
    f"""with {_OBJ} select dealer as "Biz_Assoc_Id", cast(code as int) as "Sell_Src_Cd",
      'B' || lpad(cast(dealer % 97 as varchar), 2, '0') as "Brand_Cd",
      case when code <> '99' then month_start end as "Rpt_Dt", cast(n as int) as "Obj_Cnt" from obj""",
)
def fixed_width_objectives(spark, sf_dir):
    return read_fixed_width(spark, _objective_files(spark, sf_dir), OBJECTIVE_LAYOUTS["BAC"])


@query(
    "header_dated_lines",
    f"""with {_OBJ} select month_start as header_dt, 'OBJ  ' || lpad(cast(dealer as varchar), 6, '0') || code || 'B'
      || lpad(cast(dealer % 97 as varchar), 2, '0') || (case when code = '99' then '13' else strftime(month_start, '%m') end)
      || strftime(month_start, '%d%Y') || lpad(cast(n as varchar), 7, '0') as value from obj""",
)
def header_dates(spark, sf_dir):
    lines = read_lines(spark, _objective_files(spark, sf_dir))
    return header_dated_lines(lines).select("header_dt", "value")


@query(
    "load_formats_roundtrip",
    """select fmt, count(*) as row_count, cast(sum(c_custkey) as bigint) as key_sum,
      count(distinct c_name) as names, min(c_mktsegment) as first_segment,
      cast(sum(c_nationkey) as bigint) as nation_sum, cast(sum(cast(c_acctbal as decimal(18,2))) as decimal(28,2)) as balance_sum
    from customer cross join (values ('csv'), ('txt'), ('parquet'), ('json'), ('fixed-width'), ('hive')) f(fmt) group by fmt""",
)
def load_formats(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal")
    base = scratch_dir(spark, "formats")
    rows.write.option("header", "true").csv(f"{base}/csv")
    rows.write.option("header", "true").option("sep", "~").csv(f"{base}/txt")
    rows.write.parquet(f"{base}/parquet")
    rows.write.json(f"{base}/json")
    rows.select(
        F.concat(
            F.lpad(F.col("c_custkey").cast("string"), 12, "0"), F.rpad("c_name", 20, " "), F.rpad("c_mktsegment", 12, " "),
            F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), F.lpad(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), 20, " "),
        ).alias("value")
    ).write.text(f"{base}/fixed-width")
    saved = "loaded_customers_" + base.rsplit("-", 1)[1]
    rows.write.saveAsTable(saved, path=f"{base}/hive")
    text = text_schema(*rows.columns)
    loaded = {
        "csv": load(spark, "csv", f"{base}/csv", schema=text),
        "txt": load(spark, "txt", f"{base}/txt", delimiter="tilde", schema=text),
        "parquet": load(spark, "parquet", f"{base}/parquet"),
        "json": load(spark, "json", f"{base}/json", schema=text),
        "fixed-width": load(
            spark, "fixed-width", f"{base}/fixed-width", layout=layout_from_ranges("1-12,13-32,33-44,45-48,49-68")
        ).toDF(*text.names),
        "hive": load(spark, "hive", query=f"select * from {saved}"),
    }
    out = None
    for fmt, df in loaded.items():
        part = df.agg(
            F.lit(fmt).alias("fmt"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col("c_custkey").cast("long")).alias("key_sum"),
            F.countDistinct(F.trim("c_name")).alias("names"),
            F.min(F.trim("c_mktsegment")).alias("first_segment"),
            F.sum(F.col("c_nationkey").cast("long")).alias("nation_sum"),
            F.sum(F.trim(F.col("c_acctbal").cast("string")).cast("decimal(18,2)")).alias("balance_sum"),
        )
        out = part if out is None else out.unionByName(part)
    return out


_NAME = "'MODEL_NET_' || strftime(rpt_dt, '%Y%m%d') || '.txt'"


@query(
    "valid_files",
    f"""with {STG}, days as (select distinct rpt_dt from stg)
    select {_NAME} as name, 'regex' as how from days where year(rpt_dt) = 2000
    union all select {_NAME}, 'as_of' from days where rpt_dt = date '2000-03-01'
    union all select {_NAME}, 'listed' from days where rpt_dt between date '1999-12-20' and date '2000-02-10'""",
)
def files_by_name(spark, sf_dir):
    """Daily files by pattern, by date, and from the stored listing."""
    folder = _wide_month_files(spark, sf_dir).rsplit("/", 1)[0]
    listing = scratch_dir(spark, "listing")
    store_listing(valid_files(list_files(spark, folder, LAST_FOLDER), r"MODEL_NET_\d{8}\.txt"), listing)
    files = stored_listing(spark, listing)
    span = stored_listing(spark, listing, dt.date(1999, 12, 20), dt.date(2000, 2, 10))
    found = {
        "regex": valid_files(files, r"MODEL_NET_2000\d{4}"),
        "as_of": match_pattern(files, dt.date(2000, 3, 1), "MODEL_NET_{yyyyMMdd}*"),
        "listed": span,
    }
    return reduce(DataFrame.unionByName, [f.select("name").distinct().withColumn("how", F.lit(how)) for how, f in found.items()])


def _export_files(spark, sf_dir) -> str:
    """Monthly exports whose names end in an ISO date."""
    rows = (
        inputs.table(spark, sf_dir, "lineitem")
        .groupBy(F.last_day(F.col("l_shipdate").cast("date")).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
        .select(F.concat(F.lit("export_"), F.date_format("day", "yyyy-MM-dd"), F.lit(".csv")).alias("f"), "n", "quantity")
    )
    folder = scratch_dir(spark, "exports")
    inputs.write_by_name(rows, folder, "csv")
    return folder


@query(
    "latest_file",
    """select 'export_' || strftime(max(last_day(l_shipdate)), '%Y-%m-%d') || '.csv' as name,
      cast(max(last_day(l_shipdate)) as date) as file_dt from lineitem""",
)
def latest_file(spark, sf_dir):
    return latest_by_name_date(list_files(spark, _export_files(spark, sf_dir), LAST_FOLDER))


@query(
    "new_files",
    """select distinct 'export_' || strftime(last_day(l_shipdate), '%Y-%m-%d') || '.csv' as name from lineitem
    where last_day(l_shipdate) >= date '2000-01-01'""",
)
def new_files(spark, sf_dir):
    files = list_files(spark, _export_files(spark, sf_dir), LAST_FOLDER)
    ledger = scratch_dir(spark, "ledger")
    record_processed(files.filter("name < 'export_2000'"), ledger, dt.datetime(2000, 1, 1))
    return claim_new_files(files, existing(spark, ledger, LEDGER)).select("name").distinct()


@query(
    "guarded_append",
    f"""with {STG} select rpt_dt, model_nm, cast({' + '.join(f'"{m}"' for m in MONTHS)} as int) as total from stg""",
)
def guarded_append(spark, sf_dir):
    """Two disjoint loads go in; a third that repeats a date is refused."""
    stg = inputs.staging(spark, sf_dir).select(
        "rpt_dt", "model_nm", sum((F.col(m) for m in MONTHS[1:]), F.col(MONTHS[0])).alias("total")
    )
    path = scratch_dir(spark, "guarded")
    append_if_absent(stg.filter(F.col("rpt_dt") < F.lit(CUT)), path, "rpt_dt")
    append_if_absent(stg, path, "rpt_dt")
    append_if_absent(stg.filter(F.col("rpt_dt") >= F.lit(CUT)), path, "rpt_dt")
    return existing(spark, path, stg.schema)


@query(
    "incremental_insert",
    "select * replace (cast(o_orderdate as date) as o_orderdate) from orders",
)
def incremental_insert(spark, sf_dir):
    """Old orders first, then all orders twice: each key is stored once."""
    orders = inputs.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    stage, target = scratch_dir(spark, "stage"), scratch_dir(spark, "target")
    stage_then_load(orders.filter(F.col("o_orderdate") < F.lit(CUT)), stage, target, ["o_orderkey"], within="o_orderdate")
    stage_then_load(orders, stage, target, ["o_orderkey"], within="o_orderdate")
    return stage_then_load(orders, stage, target, ["o_orderkey"], within="o_orderdate")


@query(
    "bucketed_insert",
    """select o_orderkey, case when o_orderstatus = 'F' then cast(o_orderdate as date) end as closed_on, o_custkey, o_totalprice
    from orders where o_orderstatus <> 'P'
    union all select distinct -1, null, o_custkey, 0.0 from orders where o_orderstatus = 'P'""",
)
def bucketed_insert(spark, sf_dir):
    """A target in folders by key hash; the key is an order and the day it was
    closed, which is NULL for open ones. Every load overlaps the one before."""
    orders = inputs.table(spark, sf_dir, "orders")
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("date"))
    rows = orders.select("o_orderkey", closed.alias("closed_on"), "o_custkey", "o_totalprice", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"))
    partial = F.col("o_orderstatus") == "P"
    rows = rows.withColumns({"o_orderkey": F.when(partial, -1).otherwise(F.col("o_orderkey")), "o_totalprice": F.when(partial, 0.0).otherwise(F.col("o_totalprice"))})
    stage, target = scratch_dir(spark, "stage"), scratch_dir(spark, "target")
    keys = ["o_orderkey", "closed_on", "o_custkey"]
    for days in (F.col("day") < F.lit(CUT), F.col("day") >= F.lit(CUT - dt.timedelta(days=400)), F.lit(True)):
        out = stage_then_load(rows.filter(days).select(*keys, "o_totalprice"), stage, target, keys, buckets=16)
    return out


_LINE_COLS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)


@query(
    "verify_roundtrip",
    f"""with src as (select {_LINE_COLS} from lineitem), n as (select count(*) as n from src),
    kept as (select {_LINE_COLS} from src where l_linenumber <> 7 union all select {_LINE_COLS} from src where l_returnflag = 'R'),
    a as (select {_LINE_COLS}, count(*) as s from src group by all), b as (select {_LINE_COLS}, count(*) as t from kept group by all),
    j as (select coalesce(s, 0) as s, coalesce(t, 0) as t from a full join b using ({_LINE_COLS}))
    select 'same' as copy, n as source_rows, n as stored_rows, cast(0 as bigint) as missing_rows, cast(0 as bigint) as extra_rows, true as passed from n
    union all
    select 'changed', cast(sum(s) as bigint), cast(sum(t) as bigint), cast(sum(greatest(s - t, 0)) as bigint), cast(sum(greatest(t - s, 0)) as bigint),
      sum(abs(s - t)) = 0 from j""",
)
def verify_roundtrip(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem").select(*_LINE_COLS.split(", "))
    same, changed = scratch_dir(spark, "verify"), scratch_dir(spark, "verify")
    lines.write.parquet(same)
    lines.filter("l_linenumber <> 7").unionByName(lines.filter("l_returnflag = 'R'")).write.parquet(changed)
    return verify_copies(lines, {"same": same, "changed": changed})


@query(
    "missing_arrivals",
    """with days as (select cast(unnest(generate_series((select min(cast(o_orderdate as date)) from orders), date '2001-08-20', interval 1 day)) as date) as d)
    select d as missing_dt, 'No data for ' || strftime(d, '%Y%m%d') as alert from days
    where strftime(d, '%a') <> 'Mon' and d not in (select cast(o_orderdate as date) from orders)""",
)
def arrivals(spark, sf_dir):
    days = inputs.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return missing_arrivals(days, "day", dt.date(2001, 8, 20))


@query(
    "contract_violations",
    f"""with {OOS} select * from (values
      ('vin', 'too_long', (select count(*) from oos where length(vin) > 4)),
      ('outmile', 'bad_type', (select count(*) from oos where outtype = 'R')),
      ('daysinservice', 'null', (select count(*) from oos where outtype = 'N')),
      ('dealer', 'missing', (select count(*) from oos)),
      ('loangreaterthan60', 'unexpected', (select count(*) from oos))) v("column", kind, rows) where rows > 0""",
)
def violations(spark, sf_dir):
    contract = TableContract.of(
        ("VIN", "string", 4),
        ("outDate", "date"),
        ("outMile", "int"),
        ("todayDate", "date"),
        ("outType", "string", 20),
        ("daysInService", "int", None, False),
        ("dealer", "bigint"),
    )
    rows = inputs.out_of_service(spark, sf_dir).withColumns(
        {
            "outmile": F.when(F.col("outtype") == "R", "n/a").otherwise(F.col("outmile").cast("string")),
            "daysinservice": F.when(F.col("outtype") != "N", F.col("daysinservice")),
        }
    )
    return contract_violations(rows, contract).withColumn("column", F.lower("column"))


@query("dedupe_rows", "select distinct * from lineitem")
def dedupe_rows(spark, sf_dir):
    """Header CSV in, exact duplicates out."""
    path = scratch_dir(spark, "csv")
    lines = inputs.with_copies(spark, sf_dir)
    lines.write.option("header", "true").csv(path)
    return drop_exact_duplicates(load(spark, "csv", path, schema=lines.schema))


NEST_BLOCK = 1000


def _suppliers_by_nation(spark, sf_dir):
    return inputs.table(spark, sf_dir, "supplier").join(
        inputs.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )


def _nest(rows, value):
    """State to entries, in maps of at most ``NEST_BLOCK`` entries."""
    return rows.groupBy(F.col("n_name").alias("state"), F.floor(F.col("s_suppkey") / NEST_BLOCK)).agg(
        F.map_from_entries(F.collect_list(F.struct("s_name", value))).alias("items")
    )


@query(
    "producer_dim",
    """select s_name as producer_name, n_name as state, 'Region ' || cast(n_regionkey as varchar) as location,
      s_name || '|' || n_name as producer_id from supplier join nation on s_nationkey = n_nationkey""",
)
def producer_dim(spark, sf_dir):
    place = F.concat(F.lit("Region "), F.col("n_regionkey").cast("string"))
    nested = _nest(_suppliers_by_nation(spark, sf_dir), place)
    return dimension_from_nested(nested, "state", "producer_name").withColumnRenamed("value", "location")


@query(
    "store_dim",
    """select 'S' || cast(s_suppkey as varchar) as store_id_code, s_name as city, n_name as state,
      cast(s_suppkey % 90 as double) + 0.5 as latitude, -(cast(s_suppkey % 180 as double) + 0.25) as longitude,
      case when s_acctbal < 0 then null else '555-' || cast(s_suppkey as varchar) end as phone_number,
      timestamp '2024-01-01 00:00:00' as update_timestamp
    from supplier join nation on s_nationkey = n_nationkey""",
)
def store_dim(spark, sf_dir):
    key = F.col("s_suppkey")
    info = F.struct(
        F.concat(F.lit("S"), key.cast("string")).alias("store_id_code"),
        F.concat((key % 90).cast("string"), F.lit(".5,-"), (key % 180).cast("string"), F.lit(".25")).alias("location"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("555-"), key.cast("string"))).alias("phone_number"),
    )
    nested = _nest(_suppliers_by_nation(spark, sf_dir), info)
    return store_dimension(nested, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
