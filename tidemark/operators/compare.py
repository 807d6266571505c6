"""Comparison of two versions of a dataset."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_PART = 22


def compare_datasets(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Differences: (keys..., column, left, right, kind).

    ``kind`` is ``missing_left``, ``missing_right``, ``value``,
    ``duplicate_key``, ``missing_column_left`` or ``missing_column_right``. Both
    sides go through one aggregate per key, without a join; NULL keys match. A
    key met more than once is compared as a whole, by row counts and sums of
    row hashes: equal sets of rows are no difference, others are reported with
    both counts. No group is ever multiplied out or gathered.
    """
    cols = [c for c in left.columns if c in right.columns and c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        cells = [F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(cols)]
        return df.select(*keys, F.lit(name).alias("_side"), *cells)

    values = [f"_v{i}" for i in range(len(cols))]
    both = side(left, "l").unionByName(side(right, "r"))

    def of(name: str, x: Column) -> Column:
        return F.when(F.col("_side") == name, x)

    # NULLs count: an absent value has a hash of its own
    row = F.xxhash64(F.lit(len(values)), *[F.coalesce(F.concat(F.lit("="), v), F.lit("")) for v in values])
    # Rows are kept narrow, as a task sorts them by key: instead of a sum of hashes
    # per side, the difference, in parts of ``HASH_PART`` bits whose sums fit a long.
    parts = [F.shiftrightunsigned(row, i * HASH_PART).bitwiseAND(2**HASH_PART - 1) for i in range(-(-64 // HASH_PART))]
    merged = both.groupBy(*keys).agg(
        *[F.count(of(s, F.lit(1))).alias(f"_n_{s}") for s in "lr"],
        *[F.sum(F.when(F.col("_side") == "l", x).otherwise(-x)).alias(f"_h{i}") for i, x in enumerate(parts)],
        *[F.min(of(s, F.col(v))).alias(f"_{s}{v}") for s in "lr" for v in values],
    )
    n_l, n_r = F.col("_n_l"), F.col("_n_r")
    none = F.lit(None).cast("string")

    def cell(column: Column, lv: Column, rv: Column, kind: str) -> Column:
        return F.struct(column.alias("column"), lv.alias("left"), rv.alias("right"), F.lit(kind).alias("kind"))

    repeated = (n_l > 1) | (n_r > 1)
    equal = reduce(lambda a, b: a & b, [F.col(f"_h{i}") == 0 for i in range(len(parts))], n_l == n_r)
    whole = (
        F.when(repeated & ~equal, cell(none, n_l.cast("string"), n_r.cast("string"), "duplicate_key"))
        .when(n_r == 0, cell(none, none, none, "missing_right"))
        .when(n_l == 0, cell(none, none, none, "missing_left"))
    )
    single = (n_l == 1) & (n_r == 1)
    cells = [
        F.when(single & ~F.col(f"_l{v}").eqNullSafe(F.col(f"_r{v}")), cell(F.lit(c), F.col(f"_l{v}"), F.col(f"_r{v}"), "value"))
        for c, v in zip(cols, values)
    ]
    found = merged.select(*keys, F.inline(F.array_compact(F.array(whole, *cells))))
    absent = [(c, "missing_column_right") for c in left.columns if c not in right.columns]
    absent += [(c, "missing_column_left") for c in right.columns if c not in left.columns]
    if not absent:
        return found
    rows = left.sparkSession.createDataFrame(absent, "column string, kind string")
    typed = [F.lit(None).cast(found.schema[k].dataType).alias(k) for k in keys]
    return found.unionByName(rows.select(*typed, "column", none.alias("left"), none.alias("right"), "kind"))


def compare_summary(diff: DataFrame) -> DataFrame:
    """Differences per column and kind."""
    return diff.groupBy("column", "kind").agg(F.count(F.lit(1)).alias("differences"))
