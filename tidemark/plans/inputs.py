"""Staging inputs derived from the base tables with Spark.

The base tables are retail orders; these views give them the shape of the
landing data the plans read (calendar, wide-month staging, out-of-service
rows, deliveries, dialogue lines, report cells).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.months import MONTHS
from tidemark.operators.scripts import split_lines

MODEL_COUNT = 25
PAGE_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped per model and day."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.concat(F.lit("M"), (F.col("l_suppkey") % MODEL_COUNT).cast("string")).alias("model_nm"),
            F.col("l_shipdate").cast("date").alias("dt"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sales date with its month, year and prior-year anchors."""
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("d")).distinct()
    month_start = F.trunc("d", "month")
    year_start = F.trunc("d", "year")
    return days.select(
        F.col("d").alias("sales_thru_dt"),
        month_start.alias("curr_mth_start_dt"),
        year_start.alias("curr_yr_start_dt"),
        F.add_months(year_start, -12).alias("prior_yr_start_dt"),
        F.add_months("d", -1).alias("prior_mth_current_day_date"),
        F.date_sub(month_start, 1).alias("prior_mth_end_date"),
        F.add_months("d", -12).alias("prior_year_current_day_date"),
        F.lit("US").alias("iso_ctry_cd"),
    )


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide-month staging: running monthly counts per model and day.

    Every model has a row on every day. The days are expanded by the fixed
    set of model codes and cut to the models present, so there is no cross
    join; a running sum covers one model and year, 366 rows at most.
    """
    day = ship_days(spark, sf_dir)
    codes = F.array(*[F.lit(f"M{i}") for i in range(MODEL_COUNT)])
    grid = (
        day.select("dt")
        .distinct()
        .select("dt", F.explode(codes).alias("model_nm"))
        .join(day.select("model_nm").distinct(), "model_nm", "left_semi")
    )
    full = grid.join(day, ["model_nm", "dt"], "left")
    so_far = (
        Window.partitionBy("model_nm", F.year("dt")).orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    )
    sold = F.coalesce("n", F.lit(0))
    return full.select(
        "model_nm",
        *[
            F.sum(F.when(F.month("dt") == i, sold).otherwise(0)).over(so_far).cast("int").alias(m)
            for i, m in enumerate(MONTHS, start=1)
        ],
        F.date_add("dt", 1).alias("rpt_dt"),
        F.col("dt").alias("sales_through_dt"),
    )


def out_of_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-service rows; some days-in-service groups are reported twice,
    two weeks apart."""
    shipped = F.col("l_shipdate").cast("date")
    days = (F.col("l_linenumber") * 10).cast("int")
    first_file = F.date_add(shipped, 7)
    files = F.when(days.isin(10, 40), F.array(first_file, F.date_add(first_file, 14))).otherwise(F.array(first_file))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("V"), F.col("l_partkey").cast("string")).alias("vin"),
        shipped.alias("outdate"),
        (F.col("l_quantity") * 100).cast("int").alias("outmile"),
        F.explode(files).alias("todaydate"),
        F.col("l_returnflag").alias("outtype"),
        days.alias("daysinservice"),
        F.when(F.col("l_linenumber") * 10 > 60, "Y").otherwise("N").alias("loangreaterthan60"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.col("l_suppkey") % 5
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("V"), F.col("l_partkey").cast("string")).alias("veh_id_nbr"),
        F.col("o_orderdate").cast("date").alias("orig_proc_dt"),
        F.col("l_suppkey").alias("biz_assoc_id"),
        F.when(source == 0, 11).when(source == 1, 12).when(source == 2, 13).when(source == 3, 48).otherwise(99).alias("sell_src_cd"),
        F.year("o_orderdate").alias("model_yr"),
        F.when(F.col("l_linestatus") == "F", 25).otherwise(95).alias("kpi_type_cd"),
        F.lit("US").alias("ntl_cd"),
        F.lit(1).alias("veh_deliv_cnt"),
        F.col("l_linestatus").alias("veh_prod_rpt_model_cd"),
    )


def script_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as scripts: ``ROLE: text``, one row per line."""
    talk = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat(F.upper("role"), F.lit(": "), F.col("text")).alias("text")
    )
    return split_lines(talk, "conv_id", "turn", "text")


def report_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as report sheets: one report per nation and block of
    customer numbers, one sheet per market segment. Row 1 is a title, row 2
    the header, a customer's row follows from its number, and a ``Total`` row
    closes the sheet. Rows come from the key, so nothing is numbered."""
    customers = table(spark, sf_dir, "customer").select(
        F.concat_ws(
            "-", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), F.floor(F.col("c_custkey") / PAGE_ROWS)
        ).alias("report"),
        F.col("c_mktsegment").alias("sheet"),
        (F.col("c_custkey") % PAGE_ROWS + 3).cast("int").alias("row"),
        F.col("c_custkey").cast("string").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
    )

    def cell(row, col: int, value):
        return F.struct(row.cast("int").alias("row"), F.lit(col).alias("col"), value.alias("value"))

    body = customers.select(
        "report",
        "sheet",
        F.inline(
            F.array(
                cell(F.col("row"), 1, F.col("key")),
                cell(F.col("row"), 2, F.col("name")),
                cell(F.col("row"), 3, F.col("balance").cast("string")),
            )
        ),
    )
    last = F.lit(PAGE_ROWS + 3)
    pages = customers.groupBy("report", "sheet").agg(F.sum("balance").alias("_sum"))
    frame = pages.select(
        "report",
        "sheet",
        F.inline(
            F.array(
                cell(F.lit(1), 1, F.concat_ws(" ", "report", "sheet")),
                cell(F.lit(2), 1, F.lit("Key")),
                cell(F.lit(2), 2, F.lit("Name")),
                cell(F.lit(2), 3, F.lit("Balance")),
                cell(last, 1, F.lit("Total")),
                cell(last, 3, F.col("_sum").cast("decimal(18,2)").cast("string")),
            )
        ),
    )
    return body.unionByName(frame)


VIEWS = {
    "cal": calendar,
    "stg": staging,
    "oos": out_of_service,
    "del": deliveries,
    "lines": script_lines,
}


def with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, with every seventh line of an order stored twice."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.unionByName(lines.filter("l_linenumber = 7"))


def objectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly objective counts per supplier, as text fields. Source 99 has
    no valid month, so its dates do not parse."""
    code = F.element_at(F.array(*[F.lit(c) for c in ("11", "12", "13", "48", "99")]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    month = F.trunc("l_shipdate", "month")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("dealer"), code.alias("code"), month.alias("month_start"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "dealer",
            "code",
            F.concat(F.lit("B"), F.lpad((F.col("dealer") % 97).cast("string"), 2, "0")).alias("brand"),
            "month_start",
            F.concat(
                F.when(F.col("code") == "99", "13").otherwise(F.date_format("month_start", "MM")),
                F.date_format("month_start", "ddyyyy"),
            ).alias("day_text"),
            "n",
        )
    )


def write_by_name(df: DataFrame, path: str, fmt: str = "text", splits: int = 1, **options: str) -> str:
    """Write rows to one folder per value of column ``f`` and return a glob
    over those folders. All tasks write, each its own folders; with ``splits`` a
    folder has so many files, for folders too large for a task."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    split = F.pmod(F.xxhash64(*df.columns), F.lit(splits))
    df.repartition(tasks, "f", split).write.partitionBy("f").options(**options).format(fmt).save(path)
    return f"{path}/f=*"
