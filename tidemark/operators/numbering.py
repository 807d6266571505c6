"""Exact row numbers over a whole table without one single sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

COPY_BLOCK = 100_000
#: Rows that one task should number.
RANGE_ROWS = 1_000_000


def number_rows(df: DataFrame, order: list[Column], out: str, parts: int | None = None) -> DataFrame:
    """Add the 1-based position of every row in ``order``; ties are broken by
    the remaining columns, and identical rows are interchangeable.

    Identical rows are folded into one with a count before anything moves, so
    a large group of copies is one row. The folded rows are counted, range-
    partitioned by that count (``RANGE_ROWS`` each) and stored once; each range
    is numbered on its own from the number of rows in the ranges before it (one
    small row per range).
    """
    total_order = [*order, *[F.col(c) for c in df.columns]]
    folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    if parts is None:
        folded = settle(folded, "folded")
        parts = max(1, -(-folded.count() // RANGE_ROWS))
    ranged = settle(
        folded.repartitionByRange(parts, *total_order).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_part")
        .agg(F.sum("_copies").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_part").orderBy(*total_order).rowsBetween(Window.unboundedPreceding, -1)
    # ``starts`` has one row per range of ``RANGE_ROWS`` rows.
    placed = ranged.join(F.broadcast(starts), "_part").withColumn(
        "_from", F.col("_start") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    )
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_copies") - 1), F.lit(COPY_BLOCK).cast("long")))
    in_block = F.explode(
        F.sequence(
            F.col("_from") + F.col("_block") + 1,
            F.col("_from") + F.least(F.col("_block") + COPY_BLOCK, F.col("_copies")),
        )
    )
    return placed.withColumn("_block", blocks).select(*df.columns, in_block.alias(out))
