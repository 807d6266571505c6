"""Sinks, read options, fixed layouts and the remaining small operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import OBJECTIVE_LAYOUTS, CsvSpec, Layout
from tidemark.functions.text import SPACE_CHARS
from tidemark.operators import quality, scripts
from tidemark.operators.models import ModelSpec, validate_variables
from tidemark.operators.shape import preview
from tidemark.plans import inputs
from tidemark.session import scratch_dir
from tidemark.sinks import writers
from tidemark.sources.readers import read_delimited, read_fixed_width, text_schema
from tidemark.suite.base import query
from tidemark.suite.quality import _PAD, _records

def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "sink_roundtrip",
    """with t as (select count(*) as n, sum(o_orderkey) as k, count(distinct o_orderpriority) as p from orders),
    f as (select count(*) as n, sum(o_orderkey) as k, count(distinct o_orderpriority) as p from orders where o_orderstatus = 'F')
    select sink, cast(n as bigint) as row_count, cast(k as bigint) as key_sum, p as priorities from t
      cross join (values ('table'), ('path'), ('append'), ('created_then_filled'), ('archive'), ('csv_per_group')) s(sink)
    union all select 'overwritten', n, cast(k as bigint), p from f""",
)
def sink_roundtrip(spark, sf_dir):
    """Every writer, counted and summed from what it stored. Overwriting
    sinks first hold other rows."""
    orders = inputs.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    done = orders.filter("o_orderstatus = 'F'")
    base = scratch_dir(spark, "sinks")
    name = "t" + base.rsplit("-", 1)[1]
    writers.write_table(done, f"{name}_a", f"{base}/table")
    writers.write_table(orders, f"{name}_a", f"{base}/table")
    for df in (done, orders):
        writers.write_path(df, f"{base}/path", partition_by=["o_orderstatus"])
    for df in (orders, done):
        writers.write_path(df, f"{base}/over")
    writers.write_path(done, f"{base}/append", mode="append")
    writers.write_path(orders.filter("o_orderstatus <> 'F'"), f"{base}/append", mode="append")
    made = [writers.ensure_table(spark, f"{name}_b", orders.schema) for _ in range(2)]
    assert made == [True, False]
    orders.write.mode("overwrite").insertInto(f"{name}_b")
    archived = writers.archive_raw(orders, f"{base}/raw")
    writers.write_partitioned_csv(orders, "o_orderpriority", f"{base}/csv")
    stored = {
        "table": spark.read.table(f"{name}_a"),
        "path": spark.read.parquet(f"{base}/path"),
        "overwritten": spark.read.parquet(f"{base}/over"),
        "append": spark.read.parquet(f"{base}/append"),
        "created_then_filled": spark.read.table(f"{name}_b"),
        "archive": archived,
        "csv_per_group": spark.read.option("header", "true").csv(f"{base}/csv"),
    }
    return _union(
        [
            df.agg(
                F.lit(sink).alias("sink"),
                F.count(F.lit(1)).alias("row_count"),
                F.sum(F.col("o_orderkey").cast("long")).alias("key_sum"),
                F.countDistinct("o_orderpriority").alias("priorities"),
            )
            for sink, df in stored.items()
        ]
    )


@query(
    "csv_options",
    """select o_orderkey, case when o_orderstatus = 'P' then null else o_orderstatus || '; "' || o_orderpriority || '"' end as note,
      cast(o_orderdate as date) as day, o_orderdate as at from orders""",
)
def csv_options(spark, sf_dir):
    """Quotes, escapes, null marks, comments, padding and date formats."""
    path = scratch_dir(spark, "csv")
    orders = inputs.table(spark, sf_dir, "orders")
    note = F.concat(F.col("o_orderstatus"), F.lit('; \\"'), F.col("o_orderpriority"), F.lit('\\"'))
    line = F.concat_ws(
        ";",
        F.concat(F.lit("  "), F.col("o_orderkey").cast("string")),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.concat(F.lit('"'), note, F.lit('"'))),
        F.date_format("o_orderdate", "dd.MM.yyyy"),
        F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss"),
    )
    lines = orders.select(line.alias("value")).unionByName(orders.select(F.concat(F.lit("# "), F.col("o_orderkey").cast("string")).alias("value")))
    lines.write.option("encoding", "UTF-8").text(path)
    spec = CsvSpec(
        sep=";", null_value="n/a", comment="#", trim=True, date_format="dd.MM.yyyy", timestamp_format="yyyy/MM/dd HH:mm:ss"
    )
    schema = spark.createDataFrame([], "o_orderkey bigint, note string, day date, at timestamp_ntz").schema
    return read_delimited(spark, path, schema, spec)


def _slot_text(slot, i: int):
    if slot.type == "date":
        return F.date_format("l_shipdate", "MMddyyyy")
    number = F.col("l_orderkey" if slot.type == "bigint" else "l_linenumber").cast("string")
    if slot.type in ("int", "bigint"):
        return F.lpad(number, slot.length, "0")
    return F.rpad(F.concat(F.col("l_returnflag"), F.lit(str(i))), slot.length, "x")


def _layout_lines(df: DataFrame, layout: Layout) -> DataFrame:
    parts, at = [], 1
    for i, slot in enumerate(layout.slots):
        parts += [F.lit("." * (slot.start - at)), _slot_text(slot, i)]
        at = slot.start + slot.length
    return df.select(F.concat(*parts).alias("value"))


def _layout_sql(kind: str, layout: Layout) -> str:
    cells = []
    for i, s in enumerate(layout.slots):
        if s.type == "date":
            cells.append("strftime(l_shipdate, '%Y-%m-%d')")
        elif s.type in ("int", "bigint"):
            name = "l_orderkey" if s.type == "bigint" else "l_linenumber"
            cells.append(f"cast(cast(left(lpad(cast({name} as varchar), {s.length}, '0'), {s.length}) as bigint) as varchar)")
        else:
            cells.append(f"left(rpad(l_returnflag || '{i}', {s.length}, 'x'), {s.length})")
    return f"select '{kind}' as layout, concat_ws('|', {', '.join(cells)}) as record, count(*) as n from lineitem group by 2"


@query("objective_layouts", " union all ".join(_layout_sql(k, v) for k, v in OBJECTIVE_LAYOUTS.items()))
def objective_layouts(spark, sf_dir):
    """All seven record layouts, written and sliced again. Slicing costs more
    than counting, so equal lines are counted first; those of a layout with a
    key hardly repeat."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    parts = []
    for kind, layout in OBJECTIVE_LAYOUTS.items():
        path = scratch_dir(spark, f"objectives_{kind.lower()}")
        _layout_lines(lines, layout).write.text(path)
        keyed = any(s.type == "bigint" for s in layout.slots)
        read = read_fixed_width(spark, path, layout, count=None if keyed else "lines")
        total = F.count(F.lit(1)) if keyed else F.sum("lines")
        record = F.concat_ws("|", *[F.col(s.name).cast("string") for s in layout.slots])
        parts.append(read.groupBy(record.alias("record")).agg(total.alias("n")).select(F.lit(kind).alias("layout"), "record", "n"))
    return _union(parts)


@query(
    "write_passing_files",
    f"with {_PAD} select file, count(*) as records, count(distinct l_orderkey) as orders from rec where l_suppkey % 5 <> 0 group by file",
)
def write_passing_files(spark, sf_dir):
    """Files whose sums survive padding are written, the others are not."""
    records, path = _records(spark, sf_dir), scratch_dir(spark, "passing")
    sums = quality.pad_checksum(records, "file", "record", 6, "~")
    quality.write_passing_files(records, sums, "file", path)
    key = F.substring_index("value", "~", 1)
    return spark.read.schema(text_schema("value", "file")).text(path).groupBy("file").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct(key).alias("orders")
    )


_RULE_COUNTS = """v as (select 'o_orderstatus' as variable, count(*) - count(o_orderstatus) as missing, count(distinct o_orderstatus) as unique_values from orders
      union all select 'o_totalprice', count(*) - count(o_totalprice), count(distinct o_totalprice) from orders
      union all select 'o_orderpriority', count(*) - count(o_orderpriority), count(distinct o_orderpriority) from orders)"""


@query(
    "validation_rules",
    f"""with {_RULE_COUNTS} select r.model, v.variable, v.missing, v.unique_values, r.role, r.rule,
      case r.rule when 'no_missing' then v.missing = 0 when 'binary' then v.unique_values = 2 else r.ok end as ok
    from v join (values ('logistic', 'o_orderstatus', 'y', 'no_missing', true), ('logistic', 'o_orderstatus', 'y', 'binary', true),
      ('logistic', 'o_totalprice', 'x', 'no_missing', true), ('logistic', 'o_totalprice', 'x', 'numeric', true),
      ('logistic', 'o_orderpriority', 'x', 'no_missing', true), ('logistic', 'o_orderstatus', 'y', 'y_not_in_x', true),
      ('lasso', 'o_totalprice', 'y', 'no_missing', true), ('lasso', 'o_totalprice', 'y', 'numeric', true),
      ('lasso', 'o_orderpriority', 'x', 'no_missing', true), ('lasso', 'o_orderstatus', 'x', 'no_missing', true),
      ('lasso', 'o_orderstatus', 'x', 'numeric', false), ('lasso', 'o_totalprice', 'y', 'alpha_positive', true),
      ('lasso', 'o_totalprice', 'y', 'y_not_in_x', true)) r(model, variable, role, rule, ok) on v.variable = r.variable""",
)
def validation_rules(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    specs = [
        ModelSpec("logistic", "o_orderstatus", (("o_totalprice", "continuous"), ("o_orderpriority", "categorical"))),
        ModelSpec("lasso", "o_totalprice", (("o_orderpriority", "categorical"), ("o_orderstatus", "continuous")), alpha=1.0),
    ]
    return _union([validate_variables(orders, s).withColumn("model", F.lit(s.model)) for s in specs])


@query("preview", "select * exclude (o_orderdate), cast(o_orderdate as date) as o_orderdate from orders order by o_orderkey limit 25")
def first_rows(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return preview(orders.orderBy("o_orderkey"), 25)


_NAMES = "case cast(c_custkey % 4 as int) when 0 then 'José' when 1 then 'Zoë 2' when 2 then 'ÅSE O''Neil' else '...' end"


@query(
    "speaker_lines_any_name",
    f"""with l as (select c_nationkey as script_id, c_custkey as line_no, {_NAMES} || ': ' || c_name as text from customer),
    n as (select *, case when regexp_matches(text, '^[\\p{{L}}\\p{{N}}_\\s'']+:') then trim(regexp_extract(text, '^([\\p{{L}}\\p{{N}}_\\s'']+):', 1)) end as name from l),
    c as (select *, last_value(name ignore nulls) over (partition by script_id order by line_no) as speaker from n)
    select cast(script_id as bigint) as script_id, line_no, speaker, name is not null as is_turn,
      case when name is not null then trim(substr(text, instr(text, ':') + 1), '{SPACE_CHARS}') else text end as dialogue from c where speaker is not null""",
)
def speaker_lines_any_name(spark, sf_dir):
    """Names with accents, digits and apostrophes; dots are no name."""
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, "José").when(k == 1, "Zoë 2").when(k == 2, "ÅSE O'Neil").otherwise("...")
    lines = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("long").alias("script_id"), F.col("c_custkey").alias("line_no"), F.concat(name, F.lit(": "), "c_name").alias("text")
    )
    return scripts.speaker_lines(lines, scripts.ANY_NAME).select("script_id", "line_no", "speaker", "is_turn", "dialogue")
