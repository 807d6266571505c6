"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.compare import compare_datasets, compare_summary
from tidemark.operators.models import ModelSpec, validate_variables
from tidemark.operators.shape import pad_fields
from tidemark.plans import inputs
from tidemark.suite.base import query

_PROFILE = " union all ".join(
    f"""select '{c}' as "column", '{t}' as type, count(*) as rows, count(*) - count({c}) as nulls,
    count(distinct {c}) as distinct_values from customer_gaps"""
    for c, t in [
        ("c_custkey", "bigint"),
        ("c_name", "string"),
        ("c_nationkey", "int"),
        ("c_acctbal", "double"),
        ("c_mktsegment", "string"),
    ]
)


def _customers_with_gaps(spark, sf_dir):
    """Negative balances count as not given."""
    return inputs.table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    )


@query(
    "dq_profile",
    "with customer_gaps as (select * replace (case when c_acctbal >= 0 then c_acctbal end as c_acctbal) from customer) "
    + _PROFILE,
)
def dq_profile(spark, sf_dir):
    return quality.dq_profile(_customers_with_gaps(spark, sf_dir))


def _line_rules():
    return {
        "late_lines": F.col("l_linenumber") <= 6,
        "flag_known": F.col("l_returnflag").isin("A", "N"),
        "quantity_positive": F.col("l_quantity") > 0,
    }


@query(
    "dq_rules",
    """with t as (select * from lineitem union all select * from lineitem where l_linenumber = 7),
    r as (select 'late_lines' as rule, count(*) filter (where not l_linenumber <= 6) as failed_rows from t
      union all select 'flag_known', count(*) filter (where l_returnflag not in ('A', 'N')) from t
      union all select 'quantity_positive', count(*) filter (where not l_quantity > 0) from t
      union all select 'no_duplicate_rows', (select count(*) from t) - (select count(*) from (select distinct * from t) d))
    select rule, cast(failed_rows as bigint) as failed_rows, failed_rows = 0 as passed from r""",
)
def dq_rules(spark, sf_dir):
    return quality.dq_rules(inputs.with_copies(spark, sf_dir), _line_rules())


@query(
    "dq_rejects",
    """select c_custkey, c_acctbal, c_mktsegment,
      concat_ws(',', case when c_acctbal >= 0 then null else 'balance_given' end,
        case when c_mktsegment = 'BUILDING' then 'segment_open' end) as failed_rules
    from (select * replace (case when c_acctbal >= 0 then c_acctbal end as c_acctbal) from customer) x
    where c_acctbal is null or c_mktsegment = 'BUILDING'""",
)
def dq_rejects(spark, sf_dir):
    rows = _customers_with_gaps(spark, sf_dir).select("c_custkey", "c_acctbal", "c_mktsegment")
    return quality.dq_rejects(
        rows, {"balance_given": F.col("c_acctbal") >= 0, "segment_open": F.col("c_mktsegment") != "BUILDING"}
    )


@query(
    "duplicate_values",
    "select p_name as value, count(p_name) as count from part group by p_name having count(p_name) > 1",
)
def duplicate_values(spark, sf_dir):
    return quality.duplicate_values(inputs.table(spark, sf_dir, "part"), "P_NAME")


@query(
    "duplicate_rows",
    """select * from (select *, row_number() over (order by l_returnflag, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
        l_extendedprice, l_discount, l_tax, l_linestatus, l_shipdate) as row_number
      from (select * from lineitem union all select * from lineitem where l_linenumber = 7) x) y where l_returnflag = 'N'""",
)
def duplicate_rows(spark, sf_dir):
    """A value held by a third of the rows; some rows are exact copies."""
    return quality.duplicate_rows(inputs.with_copies(spark, sf_dir), "l_returnflag", "N")


_LEFT = "select o_orderkey as order_key, o_orderstatus as status, cast(year(o_orderdate) as int) as yr from orders"
_RIGHT = """select l_orderkey as order_key, case when min(l_linestatus) = max(l_linestatus) then min(l_linestatus) else 'P' end as status,
  cast(year(min(l_shipdate)) as int) as yr from lineitem group by l_orderkey"""


@query(
    "compare_datasets",
    f"""with a as ({_LEFT}), b as ({_RIGHT}),
    j as (select coalesce(a.order_key, b.order_key) as order_key, a.order_key as ak, b.order_key as bk, a.status as s1,
      b.status as s2, a.yr as y1, b.yr as y2 from a full join b on a.order_key = b.order_key)
    select order_key, null::varchar as "column", null::varchar as "left", null::varchar as "right", 'missing_right' as kind from j where bk is null
    union all select order_key, null, null, null, 'missing_left' from j where ak is null
    union all select order_key, 'status', s1, s2, 'value' from j where ak is not null and bk is not null and s1 is distinct from s2
    union all select order_key, 'yr', cast(y1 as varchar), cast(y2 as varchar), 'value' from j
      where ak is not null and bk is not null and y1 is distinct from y2""",
)
def compare(spark, sf_dir):
    """Order status and year as booked against what the lines say."""
    orders = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("yr")
    )
    low, high = F.min("l_linestatus"), F.max("l_linestatus")
    lines = (
        inputs.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_key"))
        .agg(F.when(low == high, low).otherwise("P").alias("status"), F.year(F.min("l_shipdate")).alias("yr"))
    )
    return compare_datasets(orders, lines, ["order_key"])


@query(
    "compare_summary",
    """with a as (select l_orderkey, l_linenumber, count(*) as n, min(l_returnflag) as flag from lineitem group by 1, 2),
    b as (select l_orderkey, l_linenumber, max(case when l_linestatus = 'O' then 'open' else l_returnflag end) as flag
      from lineitem where l_linenumber <> 7 group by 1, 2),
    j as (select a.n, a.flag as f1, b.flag as f2, b.l_orderkey as bk from a left join b using (l_orderkey, l_linenumber)),
    k as (select case when n > 1 then 'duplicate_key' when bk is null then 'missing_right' when f1 <> f2 then 'value' end as kind from j)
    select case when kind = 'value' then 'flag' end as "column", kind, count(*) as differences from k where kind is not null group by 2""",
)
def summary(spark, sf_dir):
    """Lines, many of them with a repeated key, against one row per key."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    marked = F.when(F.col("l_linestatus") == "O", "open").otherwise(F.col("l_returnflag"))
    single = lines.filter("l_linenumber <> 7").groupBy(*keys).agg(F.max(marked).alias("flag"))
    return compare_summary(
        compare_datasets(lines.select(*keys, F.col("l_returnflag").alias("flag")), single, keys)
    )


def _records(spark, sf_dir):
    """``~`` records with plain, signed and non-numeric fields; suppliers
    divisible by five write a plus sign."""
    part, line = F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string")
    signed = F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit("+"), line)).otherwise(F.concat(F.lit("-"), line))
    return inputs.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("F"), F.col("l_suppkey").cast("string")).alias("file"),
        F.concat_ws(
            "~",
            F.concat(F.lit("K"), F.col("l_orderkey").cast("string")),
            part,
            signed,
            "l_returnflag",
            F.concat(F.lit(" "), (F.col("l_quantity") * 1000000).cast("long").cast("string")),
        ).alias("record"),
    )


_PAD = """rec as (select 'F' || l_suppkey as file, l_orderkey, l_partkey, l_linenumber, l_suppkey, l_returnflag,
  cast(l_quantity * 1000000 as bigint) as big from lineitem)"""


@query(
    "pad_fields",
    f"""with {_PAD} select 'K' || l_orderkey || '~' || l_partkey || '~' || (case when l_suppkey % 5 = 0 then '+' else '-' end) || l_linenumber
        || '~' || l_returnflag || '~ ' || big as record,
      'K' || l_orderkey || '~' || format('{{:06d}}', l_partkey) || '~'
        || (case when l_suppkey % 5 = 0 then format('{{:06d}}', l_linenumber) else format('{{:06d}}', -l_linenumber) end)
        || '~' || l_returnflag || '~' || format('{{:06d}}', big) as padded from rec""",
)
def padded(spark, sf_dir):
    return pad_fields(_records(spark, sf_dir).select("record"), "record", 6, "~")


@query(
    "pad_checksum",
    f"""with {_PAD}, s as (
      select file, 0 as position, sum(l_partkey) as b, sum(l_partkey) as a from rec group by file
      union all select file, 1, 0, sum(case when l_suppkey % 5 = 0 then l_linenumber else 0 end) from rec group by file
      union all select file, 2, 0, 0 from rec group by file
      union all select file, 3, sum(big), sum(big) from rec group by file)
    select file, cast(position as int) as position, cast(cast(b as hugeint) as varchar) as sum_before, cast(cast(a as hugeint) as varchar) as sum_after, a = b as passed from s""",
)
def checksum(spark, sf_dir):
    return quality.pad_checksum(_records(spark, sf_dir), "file", "record", 6, "~")


@query(
    "passing_files",
    "select distinct 'F' || l_suppkey as file from lineitem where l_suppkey % 5 <> 0",
)
def passing_files(spark, sf_dir):
    return quality.passing_files(checksum(spark, sf_dir), "file")


@query(
    "variable_validation",
    """with v as (select 'o_totalprice' as variable, count(*) - count(o_totalprice) as missing, count(distinct o_totalprice) as unique_values from orders
      union all select 'o_custkey', count(*) - count(o_custkey), count(distinct o_custkey) from orders
      union all select 'closed_on', count(*) - count(case when o_orderstatus = 'F' then o_orderdate end),
        count(distinct case when o_orderstatus = 'F' then o_orderdate end) from orders)
    select v.variable, v.missing, v.unique_values, r.role, r.rule,
      case when r.rule = 'no_missing' then v.missing = 0 else r.ok end as ok
    from v join (values ('o_totalprice', 'y', 'no_missing', true), ('o_totalprice', 'y', 'numeric', true),
      ('o_totalprice', 'y', 'y_not_in_x', true), ('o_custkey', 'x', 'no_missing', true), ('o_custkey', 'x', 'numeric', true),
      ('closed_on', 'x', 'no_missing', true), ('closed_on', 'x', 'numeric', false)) r(variable, role, rule, ok)
      on v.variable = r.variable""",
)
def variables(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").withColumn(
        "closed_on", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("date"))
    )
    spec = ModelSpec("linear", "o_totalprice", (("o_custkey", "continuous"), ("closed_on", "continuous")))
    return validate_variables(orders, spec)
