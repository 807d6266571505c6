"""Joins with a stated treatment of NULL keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def same_keys(keys: list[str], prefix: str) -> Column:
    """Null-safe equality of each key with its ``prefix``-renamed twin. The
    renaming keeps both sides apart when they come from one DataFrame."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def not_in(df: DataFrame, other: DataFrame, keys: list[str], strict_null: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is not among the keys of ``other``.

    Default: rows with a NULL key part are dropped and NULL keys in ``other``
    are ignored. ``strict_null=True`` is SQL ``NOT IN`` on the joined key: one
    NULL key in ``other`` empties the result, and an empty ``other`` keeps
    every row.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    listed = other.select(*keys)
    plain = df.filter(whole).join(listed.filter(whole), keys, "left_anti")
    if not strict_null:
        return plain
    # Both guards are scalar subqueries over limit(1): they stop at one row.
    nulls = listed.filter(~whole).limit(1).agg(F.count(F.lit(1))).scalar()
    any_row = listed.limit(1).agg(F.count(F.lit(1))).scalar()
    return plain.filter(nulls == 0).unionByName(df.filter(~whole & (any_row == 0)))
