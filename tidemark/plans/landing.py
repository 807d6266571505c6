"""Landing-file plans: staging loads and dated, idempotent ingestion."""

from __future__ import annotations

import datetime as dt


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import CsvSpec
from tidemark.functions.months import MONTHS
from tidemark.operators.shape import cast_columns, parse_dates
from tidemark.sources.readers import (
    from_path,
    path_date,
    read_dated,
    read_delimited,
    text_schema,
    with_lineage,
)

WIDE_MONTH = text_schema("model_nm", *MONTHS)
WIDE_MONTH_NAME = r"MODEL_NET_(\d{8})"
OUT_OF_SERVICE = text_schema("vin", "outdate", "outmile", "todaydate", "outtype", "daysinservice", "loangreaterthan60")
SUPPLY = text_schema("supplier_name", "produce_type", "quantity", "today_date")


def stage_wide_month(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``~`` files without header to typed staging rows; the report date comes
    from the file path and sales run through the day before."""
    raw = read_delimited(spark, path, WIDE_MONTH, CsvSpec(sep="~"))
    dated = with_lineage(raw, {"rpt_dt": path_date(WIDE_MONTH_NAME)})
    typed = cast_columns(dated, {m: "int" for m in MONTHS})
    return typed.select("model_nm", *MONTHS, "rpt_dt", F.date_sub("rpt_dt", 1).alias("sales_through_dt"))


def stage_out_of_service(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``|`` files without header, dates as MM/dd/yyyy."""
    raw = read_delimited(spark, path, OUT_OF_SERVICE, CsvSpec(sep="|"))
    dated = parse_dates(raw, {"outdate": "MM/dd/yyyy", "todaydate": "MM/dd/yyyy"})
    return cast_columns(dated, {"outmile": "int", "daysinservice": "int"})


def ingest_for_date(spark: SparkSession, folder: str, as_of: dt.date) -> DataFrame:
    """All state supply files of one date, with file path and state."""
    rows = read_dated(spark, folder, "*_grocery_supply_{yyyyMMdd}*", as_of, SUPPLY, CsvSpec(header=True))
    return with_lineage(rows, {"state": from_path(r".*/(?:[^/=]+=)?([^/]+)_grocery_supply_\d{8}")})
