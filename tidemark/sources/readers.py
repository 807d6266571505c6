"""Readers for landing files. Schemas are explicit; values are cast later."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import CsvSpec, Layout
from tidemark.functions.dates import parse_date
from tidemark.functions.text import DELIMITERS, whole_number
from tidemark.session import settle

# Python date directives used in name templates, as regular
# expressions and as Spark date patterns.
DAY_FORMATS = {"yyyyMMdd": "%Y%m%d", "MMddyyyy": "%m%d%Y", "yyyy-MM-dd": "%Y-%m-%d"}

#: Header rows that may be sent to every task (about 150 bytes each).
HEADER_FILES = 100_000
FILE_SPLITS = 32


def text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: T.StructType, spec: CsvSpec | None = None
) -> DataFrame:
    """Delimited files by explicit schema (given to the reader, not as an
    option). With ``permissive`` bad rows keep their text in
    ``_corrupt_record``."""
    spec = spec or CsvSpec()
    if spec.permissive:
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).options(**spec.options()).csv(path)


def dated_name(template: str, as_of: dt.date) -> str:
    """``MODEL_NET_{yyyyMMdd}.txt`` for a date; several dates may appear."""
    for token, directive in DAY_FORMATS.items():
        template = template.replace("{" + token + "}", as_of.strftime(directive))
    return template


def read_dated(
    spark: SparkSession, folder: str, template: str, as_of: dt.date, schema: T.StructType, spec: CsvSpec | None = None
) -> DataFrame:
    """The file or files of one date; the name may hold wildcards."""
    return read_delimited(spark, f"{folder}/{dated_name(template, as_of)}", schema, spec)


def with_lineage(df: DataFrame, groups: dict[str, Column] | None = None) -> DataFrame:
    """Add ``file_path`` and columns derived from it."""
    out = df.withColumn("file_path", F.col("_metadata.file_path"))
    return out.withColumns(groups) if groups else out


def from_path(pattern: str, group: int = 1) -> Column:
    return F.regexp_extract("file_path", pattern, group)


def path_date(pattern: str, fmt: str = "yyyyMMdd") -> Column:
    return parse_date(from_path(pattern), fmt)


def slice_record(layout: Layout, value: str = "value") -> list[Column]:
    """One typed column per field of a fixed-width record."""
    out = []
    for s in layout.slots:
        raw = F.substring(value, s.start, s.length)
        if s.type == "date":
            cell = parse_date(raw, s.fmt or "yyyyMMdd")
        elif s.type == "string":
            cell = raw
        elif s.type in ("int", "bigint"):
            cell = whole_number(raw, s.type)
        else:
            cell = F.trim(raw).try_cast(s.type)
        out.append(cell.alias(s.name))
    return out


def read_fixed_width(
    spark: SparkSession, path: str | list[str], layout: Layout, header_prefix: str | None = "HDR", count: str | None = None
) -> DataFrame:
    """Fixed-width text, header lines left out, in one projection. With a
    column name for the ``count``, equal lines are one row and are sliced once."""
    lines = spark.read.text(path)
    if header_prefix:
        lines = lines.filter(~F.col("value").startswith(header_prefix))
    if count is None:
        return lines.select(*slice_record(layout))
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias(count)).select(*slice_record(layout), count)


def header_dates(lines: DataFrame, prefix: str = "HDR") -> DataFrame:
    """(file_path, header_dt): the date at characters 9-18 of each file's
    header line."""
    return (
        lines.filter(F.col("value").startswith(prefix))
        .select("file_path", parse_date(F.substring("value", 9, 10), "MM/dd/yyyy").alias("header_dt"))
        .groupBy("file_path")
        .agg(F.min("header_dt").alias("header_dt"))
    )


def header_dated_lines(lines: DataFrame, prefix: str = "HDR", most: int = HEADER_FILES) -> DataFrame:
    """Data lines with the date from the header of their file.

    The headers, one row per file, are stored and counted. Up to ``most`` of them
    are sent to the data lines, which then stay where they were read. Beyond
    that the lines are shuffled by file and split of it, so that a large file is
    many keys.
    """
    heads = settle(header_dates(lines, prefix), "headers")
    body = lines.filter(~F.col("value").startswith(prefix))
    if heads.count() <= most:
        return body.join(F.broadcast(heads), "file_path", "left")
    splits = F.explode(F.sequence(F.lit(0), F.lit(FILE_SPLITS - 1)))
    salted = body.withColumn("_split", F.pmod(F.spark_partition_id(), F.lit(FILE_SPLITS)))
    return salted.join(heads.withColumn("_split", splits), ["file_path", "_split"], "left").drop("_split")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return with_lineage(spark.read.text(path))


def load(spark: SparkSession, fmt: str, path: str | None = None, **opts) -> DataFrame:
    """Load one of the supported formats.

    csv, txt (``delimiter`` by name or character), parquet, json, fixed-width
    (``layout``), hive (``query`` or ``table``), jdbc (``url``, ``dbtable``,
    ...). Excel and Avro need connectors that Spark does not ship.
    """
    kind = fmt.lower()
    header = str(opts.pop("header", "true")).lower()
    schema = opts.pop("schema", None)
    if kind in ("csv", "txt"):
        sep = opts.pop("delimiter", "comma")
        reader = spark.read.option("header", header).option("sep", DELIMITERS.get(sep, sep))
        return (reader.schema(schema) if schema else reader).options(**opts).csv(path)
    if kind == "parquet":
        return spark.read.options(**opts).parquet(path)
    if kind == "json":
        reader = spark.read.options(**opts)
        return (reader.schema(schema) if schema else reader).json(path)
    if kind == "fixed-width":
        return read_fixed_width(spark, path, opts.pop("layout"), opts.pop("header_prefix", None))
    if kind == "hive":
        return spark.sql(opts["query"]) if "query" in opts else spark.read.table(opts["table"])
    if kind == "jdbc":
        return spark.read.format("jdbc").options(**opts).load()
    if kind in ("xlsx", "avro"):
        raise ValueError(f"format {fmt!r} needs a connector that is not part of Spark")
    raise ValueError(f"unknown format {fmt!r}")


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def query(spark: SparkSession, text: str, **args) -> DataFrame:
    """SQL text with named parameters (``:as_of``)."""
    return spark.sql(text, args=args)
