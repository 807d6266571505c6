"""Projection, filter and naming helpers, each one DataFrame in, one out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_date
from tidemark.functions.months import MONTHS
from tidemark.functions.text import pad_record, strip, whole_number

WHOLE_TYPES = {"tinyint", "smallint", "int", "bigint"}


def _names(names: str) -> list[str]:
    return [n.strip() for n in names.split(",")]


def with_column(df: DataFrame, name: str, expr: Column | str) -> DataFrame:
    return df.withColumn(name, F.expr(expr) if isinstance(expr, str) else expr)


def filter_rows(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.filter(condition)


def drop_column(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename; nothing happens if ``old`` is absent."""
    return df.withColumnRenamed(old, new)


def select_columns(df: DataFrame, names: str) -> DataFrame:
    """Columns from a comma-separated list."""
    return df.select(*_names(names))


def sort_by(df: DataFrame, names: str) -> DataFrame:
    return df.sort(*_names(names))


def group_by(df: DataFrame, names: str) -> GroupedData:
    return df.groupBy(*_names(names))


def preview(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows."""
    return df.limit(n)


def cast_columns(df: DataFrame, types: dict[str, str], on_error: str = "null") -> DataFrame:
    """Cast columns by name in one projection. Bad text gives NULL, or an
    error with ``on_error="fail"``."""
    wanted = {k.lower(): v for k, v in types.items()}

    def one(name: str) -> Column:
        kind = wanted.get(name.lower())
        if kind is None:
            return F.col(name)
        cell = F.col(name)
        if on_error == "fail":
            return cell.cast(kind).alias(name)
        if source[name] == "string" and kind in WHOLE_TYPES:
            return whole_number(cell, kind).alias(name)
        return cell.try_cast(kind).alias(name)

    source = dict(df.dtypes)
    return df.select(*[one(c) for c in df.columns])


def parse_dates(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """Text columns to dates by format; text that does not fit gives NULL."""
    return df.select(
        *[parse_date(F.col(c), formats[c]).alias(c) if c in formats else F.col(c) for c in df.columns]
    )


def label_codes(df: DataFrame, column: str, labels: dict[int, str], out: str) -> DataFrame:
    """Code to label; a code without a label gives NULL."""
    chain = None
    for code, text in labels.items():
        chain = (F if chain is None else chain).when(F.col(column) == code, text)
    return df.withColumn(out, chain)


def concat_key(columns: list[str], *extra: str) -> Column:
    """``a|b|c``; NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for piece in [F.col(c).cast("string") for c in columns] + [F.lit(e) for e in extra]:
        parts += [F.lit("|"), piece] if parts else [piece]
    return F.concat(*parts)


def audit_columns(
    df: DataFrame,
    key_cols: list[str],
    source_id: str,
    job_id: str,
    run_ts: dt.datetime | Column,
    key_names_col: str = "Src_Sys_Uniq_Prim_Key_Col_Val",
) -> DataFrame:
    """Add load-audit columns. ``run_ts`` is passed in so a re-run gives the
    same rows."""
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return df.withColumns(
        {
            "Src_Sys_Id": F.lit(source_id),
            "Src_Sys_Uniq_Prim_Key_Val": concat_key(key_cols, source_id),
            key_names_col: F.lit("|".join([*key_cols, "Src_Sys_Id"])),
            "Meas_Cnt": F.lit(1),
            "Dw_Anom_Flg": F.lit("N"),
            "Dw_Mod_Ts": stamp,
            "Dw_Job_Id": F.lit(job_id),
            "Src_Sys_Iud_Cd": F.lit("I"),
        }
    )


def pad_fields(df: DataFrame, column: str, width: int, delimiter: str, out: str = "padded") -> DataFrame:
    """Zero-pad the numeric fields of delimited records; blank lines go."""
    return df.filter(strip(F.col(column)) != "").withColumn(out, pad_record(F.col(column), width, delimiter))


def unpivot_months(df: DataFrame, id_cols: list[str], value: str = "value") -> DataFrame:
    """Twelve month columns to rows (month_no, month, value): a row-local
    generator, so no shuffle and one scan instead of twelve."""
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("month_no"), F.lit(m.capitalize()).alias("month"), F.col(m).alias(value)
            )
            for i, m in enumerate(MONTHS, start=1)
        ]
    )
    return df.select(*id_cols, F.inline(rows))
