"""Which files were processed, and which days are missing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import is_monday
from tidemark.operators.carry import date_spine
from tidemark.sinks.writers import existing

LEDGER = T.StructType([T.StructField("path", T.StringType()), T.StructField("processed_at", T.TimestampNTZType())])


def claim_new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files the ledger does not hold."""
    return listing.join(ledger.select("path"), "path", "left_anti")


def record_processed(files: DataFrame, ledger_path: str, at: dt.datetime) -> None:
    """Enter files in the ledger, after their load succeeded."""
    stored = existing(files.sparkSession, ledger_path, LEDGER)
    claim_new_files(files.select("path").distinct(), stored).select("path", F.lit(at).alias("processed_at")).write.mode(
        "append"
    ).parquet(ledger_path)


def missing_arrivals(data: DataFrame, day_col: str, as_of: dt.date) -> DataFrame:
    """Days without data from the first one to ``as_of``; no file is due on
    Mondays. One alert row per day."""
    spine = date_spine(data, day_col, as_of, "missing_dt").filter(~is_monday(F.col("missing_dt")))
    arrived = data.select(F.col(day_col).alias("missing_dt")).distinct()
    return spine.join(arrived, "missing_dt", "left_anti").withColumn(
        "alert", F.concat(F.lit("No data for "), F.date_format("missing_dt", "yyyyMMdd"))
    )
