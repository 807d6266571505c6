"""File listings as DataFrames: (path, name, length, modified)."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_date
from tidemark.sources.readers import dated_name

ISO_DAY = r"(\d{4}-\d{2}-\d{2})"
LISTING = "path string, length long, modified timestamp, name string, file_dt date, file_month string"


def list_files(spark: SparkSession, folder: str, name_pattern: str = r"([^/]+)$") -> DataFrame:
    """Every non-empty file below ``folder``; only names and sizes are read. The name
    is the first group of ``name_pattern`` in the path."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    return found.withColumn("name", F.regexp_extract("path", name_pattern, 1))


def valid_files(files: DataFrame, pattern: str) -> DataFrame:
    """Non-empty files whose name matches from its start."""
    return files.filter((F.col("length") > 0) & F.col("name").rlike(rf"\A(?:{pattern})"))


def list_valid(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """As ``valid_files`` over a folder; an error if there is none."""
    found = valid_files(list_files(spark, folder), pattern)
    if found.isEmpty():
        raise FileNotFoundError(f"no non-empty file in {folder} matches {pattern!r}")
    return found


def latest_by_name_date(files: DataFrame, suffix: str = ".csv") -> DataFrame:
    """The file with the newest ``yyyy-MM-dd`` in its name, one row."""
    day = parse_date(F.regexp_extract("name", ISO_DAY, 1), "yyyy-MM-dd")
    dated = files.filter(F.lower("name").endswith(suffix)).withColumn("_day", day).filter("_day is not null")
    return dated.agg(F.max_by("name", F.struct("_day", "name")).alias("name"), F.max("_day").alias("file_dt")).filter(
        "name is not null"
    )


def match_pattern(files: DataFrame, as_of: dt.date, template: str) -> DataFrame:
    """Files of a date: ``Out_{MMddyyyy}_new_{yyyyMMdd}*.txt``, where ``*``
    is any text."""
    parts = [re.escape(p) for p in dated_name(template, as_of).split("*")]
    return files.filter(F.col("name").rlike(rf"\A{'.*'.join(parts)}\z"))


def store_listing(files: DataFrame, path: str, date_pattern: str = r"(\d{8})", fmt: str = "yyyyMMdd") -> None:
    """Add a listing to the listing table at ``path``, partitioned by the year
    and month of the date in each name (NULL without one)."""
    day = parse_date(F.regexp_extract("name", date_pattern, 1), fmt)
    dated = files.withColumn("file_dt", day).withColumn("file_month", F.date_format("file_dt", "yyyy-MM"))
    dated.hint("rebalance", "file_month").write.mode("append").partitionBy("file_month").parquet(path)


def stored_listing(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Listed files dated ``first`` to ``last``; only the months between are
    read."""
    listed = spark.read.schema(LISTING).parquet(path)
    for day, month, bound in ((first, "file_month >= '{}'", "file_dt >= '{}'"), (last, "file_month <= '{}'", "file_dt <= '{}'")):
        if day:
            listed = listed.filter(month.format(day.strftime("%Y-%m"))).filter(bound.format(day))
    return listed.drop("file_month")
