"""Carry-forward, lag and as-of over ordered series.

A series may hold a third of all rows, so none of these put a whole series in
one window partition. Rows go to slots (a month, a block of line numbers) that
grow with the order column. A task handles one slot; what enters the slot from
before comes from one summary row per slot, and only those summaries are
windowed per series.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.operators.joins import same_keys
from tidemark.session import settle


def _enter(df: DataFrame, carried: DataFrame, by: list[str]) -> DataFrame:
    keys = [*by, "_slot"]
    renamed = carried.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_in")
    return df.join(renamed, same_keys(keys, "_k_"), "left").drop(*[f"_k_{k}" for k in keys])


def locf(df: DataFrame, by: list[str], order: str, cols: list[str], slot: Column) -> DataFrame:
    """Fill NULLs in ``cols`` with the last value before them in the series.

    ``order`` must be unique within ``by``; ``slot`` must not decrease as
    ``order`` grows.
    """
    slotted = df.withColumn("_slot", slot)
    last_of = slotted.groupBy(*by, "_slot").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols]
    )
    earlier = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = last_of.select(
        *by, "_slot", F.struct(*[F.last(c, ignorenulls=True).over(earlier).alias(c) for c in cols]).alias("_in")
    )
    inside = Window.partitionBy(*by, "_slot").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = {
        c: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"_in.{c}")).alias(c) for c in cols
    }
    return _enter(slotted, carried, by).select(*[filled.get(c, F.col(c)) for c in df.columns])


def previous(df: DataFrame, by: list[str], order: str, col: str, out: str, slot: Column) -> DataFrame:
    """``lag(col)`` along the series: the value of the row just before."""
    slotted = df.withColumn("_slot", slot)
    ends = slotted.groupBy(*by, "_slot").agg(F.max_by(F.struct(F.col(col).alias("v")), order).alias("_end"))
    carried = ends.select(*by, "_slot", F.lag("_end").over(Window.partitionBy(*by).orderBy("_slot")).alias("_in"))
    inside = Window.partitionBy(*by, "_slot").orderBy(order)
    value = F.when(F.row_number().over(inside) == 1, F.col("_in.v")).otherwise(F.lag(col).over(inside))
    return _enter(slotted, carried, by).select(*df.columns, value.alias(out))


def asof_latest(df: DataFrame, date_col: str, value_col: str, as_of: Column) -> DataFrame:
    """One row: the newest non-null value dated on or before ``as_of``."""
    usable = (F.col(date_col) <= as_of) & F.col(value_col).isNotNull()
    return df.filter(usable).agg(F.max_by(value_col, date_col).alias(value_col))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_t: str,
    right_t: str,
    value: str,
    slot,
    out: str | None = None,
) -> DataFrame:
    """Per left row, ``value`` of the newest right row of the same key dated
    on or before it (NULL if none).

    Both sides first shrink to one row per key and time, so copies cost
    nothing; the times are then filled slot by slot and joined back on
    equality. ``slot`` maps a time column to its slot.
    """
    out = out or value
    known = right.groupBy(*by, F.col(right_t).alias("_t")).agg(F.max(value).alias("_v"))
    asked = left.select(*by, F.col(left_t).alias("_t")).distinct()
    times = (
        asked.withColumn("_v", F.lit(None).cast(right.schema[value].dataType))
        .unionByName(known)
        .groupBy(*by, "_t")
        .agg(F.max("_v").alias("_v"))
    )
    # the slots' summaries and the fill both read these rows
    filled = locf(settle(times, "times"), by, "_t", ["_v"], slot(F.col("_t")))
    looked = left.withColumn("_t", F.col(left_t)).join(filled, [*by, "_t"], "left")
    return looked.select(*[left_col for left_col in left.columns], F.col("_v").alias(out))


def date_spine(df: DataFrame, col: str, as_of: dt.date, out: str = "day") -> DataFrame:
    """Every date from the first in ``col`` to ``as_of``."""
    first = df.agg(F.min(col).alias("_first")).filter(F.col("_first") <= as_date(as_of))
    return first.select(F.explode(F.sequence(F.col("_first"), as_date(as_of))).alias(out))
