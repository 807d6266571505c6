"""Report-sheet queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import reports
from tidemark.plans import inputs
from tidemark.suite.base import query

PAGE = inputs.PAGE_ROWS

# Ranges read from every sheet, as the lines of a configuration file:
# (frame, header1, header2, start, stop, control column, end column, data, headers).
RANGE_LINES = [
    ("all", "", "", "", "", "", "", f"A3:C{PAGE + 2}", "A2:C2"),
    ("names", "Page", " ", "", "", "", "", f"B3:B{PAGE + 2}", "B2:B2"),
    ("mixed", "", "", "", "", "", "", f"A3:C{PAGE + 2}", "A2:B2"),
    ("marked", "Key", "Total", "Key", "Total", "A", "B", "", ""),
    ("unmarked", "", "", "Nothing", "Total", "A", "B", "", ""),
    ("words", "", "", "TRUE", "null", "C", "C", "", ""),
    ("flagged", "", "", "", "", "", "", f"A3:C{PAGE + 2}", "TRUE"),
    ("nothing", "", "", "", "", "", "", f"A3:C{PAGE + 2}", "Null"),
    ("noheader", "", "", "", "", "", "", f"A3:C{PAGE + 2}", ""),
    ("typo", "", "", "", "", "", "", f"A3:C{PAGE + 2}", "row 2"),
]


def _config(spark, sf_dir):
    """One line per market segment and range; the segments are the sheets."""
    segments = inputs.table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.min("c_custkey").alias("_first"))
    fields = ["frame", "header1", "header2", "start", "stop", "control_column", "end_column", "data", "dynamic_headers"]
    ranges = F.array(
        *[
            F.struct(
                F.lit(i).alias("range_no"), *[F.lit(v).alias(n) for n, v in zip(fields, line)]
            )
            for i, line in enumerate(RANGE_LINES)
        ]
    )
    return segments.select(
        F.col("c_mktsegment").alias("sheet_key"),
        F.concat(F.lit("S"), F.col("_first").cast("string")).alias("sheet_id"),
        "_first",
        F.inline(ranges),
    ).select(
        (F.col("_first") * len(RANGE_LINES) + F.col("range_no")).alias("line_no"),
        "sheet_key",
        "sheet_id",
        *fields,
    )


def _values(lines) -> str:
    return ", ".join("(" + ", ".join([str(i), *[f"'{v}'" for v in line]]) + ")" for i, line in enumerate(lines))


_CFG = f"""cfg as (select s._first * {len(RANGE_LINES)} + r.range_no as line_no, s.sheet_key, 'S' || s._first as sheet_id, r.*
  from (select c_mktsegment as sheet_key, min(c_custkey) as _first from customer group by 1) s
  cross join (values {_values(RANGE_LINES)}) r(range_no, frame, header1, header2, start_v, stop_v, control_v, end_v, data_v, head_v))"""


@query(
    "report_config",
    f"""with {_CFG} select cast(dense_rank() over (order by (select min(line_no) from cfg c where c.sheet_key = g.sheet_key)) as int) as sheet_index,
      sheet_id, sheet_key as sheet, frame, line_no,
      case when frame = 'names' then 'B:B' when start_v = '' then 'A:C' end as data_range,
      case frame when 'all' then 'A:C' when 'names' then 'B:B' when 'mixed' then 'A:B' end as header_range,
      case when data_v <> '' then cast(2 as int) end as skiprows_data,
      case when data_v <> '' then cast({PAGE} as int) end as nrows_data,
      case when head_v like '%:%' then cast(1 as int) end as header_rows_skip,
      case when head_v like '%:%' then cast(1 as int) end as nrows_header,
      case frame when 'flagged' then 'true' when 'nothing' then null when 'typo' then 'row 2' else case when start_v <> '' then 'false' else head_v end end
        as use_dynamic_headers,
      case when start_v <> '' or frame = 'flagged' then 'flag' when frame = 'nothing' then 'none' when frame = 'noheader' then 'empty'
        when frame = 'typo' then 'text' else 'range' end as header_kind,
      case frame when 'names' then 'Page' when 'marked' then 'Key|Total' else '' end as prepend_headers,
      start_v <> '' as use_markers,
      case frame when 'marked' then 'Key' when 'unmarked' then 'Nothing' when 'words' then 'true' end as start_value,
      case frame when 'marked' then 'Total' when 'unmarked' then 'Total' end as stop_value,
      case when start_v <> '' then control_v end as control_column, case when start_v <> '' then end_v end as end_column
    from cfg g""",
)
def report_config(spark, sf_dir):
    return reports.build_range_config(_config(spark, sf_dir))


def _extracted(spark, sf_dir, frames):
    config = reports.build_range_config(_config(spark, sf_dir)).filter(F.col("frame").isin(frames))
    return reports.extract_ranges(inputs.report_cells(spark, sf_dir), config)


_PAGES = f"""page as (select 'N' || c_nationkey || '-' || (c_custkey // {PAGE}) as report, c_mktsegment as sheet, c_custkey,
  cast(c_custkey % {PAGE} + 1 as int) as row_no, c_name, cast(cast(c_acctbal as decimal(18,2)) as varchar) as balance from customer)"""


@query(
    "report_ranges",
    f"""with {_PAGES} select report, sheet, 'all' as frame, row_no, cast(1 as int) as col_no, 'Key' as header, cast(c_custkey as varchar) as value from page
    union all select report, sheet, 'all', row_no, 2, 'Name', c_name from page
    union all select report, sheet, 'all', row_no, 3, 'Balance', balance from page
    union all select report, sheet, 'names', row_no, 1, 'Name', c_name from page""",
)
def report_ranges(spark, sf_dir):
    return _extracted(spark, sf_dir, ["all", "names", "mixed"])[0]


@query(
    "report_marker_ranges",
    f"""with {_PAGES} select report, sheet, 'marked' as frame, row_no, cast(1 as int) as col_no, 'Key' as header, cast(c_custkey as varchar) as value from page
    union all select report, sheet, 'marked', row_no, 2, 'Name', c_name from page""",
)
def marker_ranges(spark, sf_dir):
    return _extracted(spark, sf_dir, ["marked"])[0]


@query(
    "report_table",
    f"with {_PAGES} select report, sheet, 'all' as frame, row_no, cast(c_custkey as varchar) as \"Key\", c_name as \"Name\", balance as \"Balance\" from page",
)
def report_table(spark, sf_dir):
    return reports.widen(_extracted(spark, sf_dir, ["all"])[0], ["Key", "Name", "Balance"])


@query(
    "report_failures",
    f"""with {_PAGES}, n as (select count(*) as n from (select distinct report, sheet from page) x)
    select 'loaded' as status, null::varchar as error, 3 * n as ranges from n
    union all select 'failed', 'range is 3 columns wide but its header 2', n from n
    union all select 'failed', 'header range missing', 4 * n from n
    union all select 'failed', 'start value not found', 2 * n from n""",
)
def report_failures(spark, sf_dir):
    frames = [line[0] for line in RANGE_LINES]
    return reports.load_summary(*_extracted(spark, sf_dir, frames))


PRIORITY = ["Brand#2", "Brand#17", "Brand#4", "Brand#9"]
_TOTALS = ", ".join(f"'{b} Total'" for b in PRIORITY)


@query(
    "report_order",
    f"""with rows as (select p_brand as brand, p_name as model, cast(sum(p_size) as bigint) as units from part group by 1, 2
      union all select p_brand, p_brand || ' Total', cast(sum(p_size) as bigint) from part group by 1
      union all select p_brand, 'Extra Total', cast(count(*) as bigint) from part group by 1)
    select brand, model, units, row_number() over (order by
      case brand {' '.join(f"when '{b}' then {i}" for i, b in enumerate(PRIORITY, 1))} else {len(PRIORITY) + 1} end, brand,
      case when model in ({_TOTALS}) then 2 else 1 end, split_part(model, ' ', 1),
      case when model like '% Total' and model not in ({_TOTALS}) then 2 else 1 end, model, units) as sort_rank from rows""",
)
def report_order(spark, sf_dir):
    part = inputs.table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("model"), "p_size")
    models = part.groupBy("brand", "model").agg(F.sum("p_size").alias("units"))
    totals = part.groupBy("brand").agg(F.sum("p_size").alias("units"), F.count(F.lit(1)).alias("n"))
    rows = models.unionByName(
        totals.select("brand", F.concat("brand", F.lit(" Total")).alias("model"), "units")
    ).unionByName(totals.select("brand", F.lit("Extra Total").alias("model"), F.col("n").alias("units")))
    return reports.report_order(rows, "brand", "model", PRIORITY)
