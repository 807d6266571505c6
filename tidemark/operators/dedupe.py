"""One row per key, with a stated winner."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import same_keys


def dedupe(df: DataFrame, keys: list[str], order: str, keep: str = "last") -> DataFrame:
    """Keep the newest (``last``) or oldest (``first``) row per key.

    Keys are compared column by column, NULLs together. Ties on ``order`` go
    to the remaining columns, so the result never depends on row order. The
    ``row_number() = 1`` form lets Spark cut every map task down to one row
    per key before the shuffle, so a large group of copies does not gather.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    rest = [c for c in df.columns if c not in keys and c != order]
    ordering = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in [order, *rest]]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
    return ranked.filter("_rn = 1").drop("_rn")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def merge_first_nonnull(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """Per key, for each column its first non-null value in ``order``."""
    position = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in cols]
    )


def first_seen_on(df: DataFrame, keys: list[str], order: str, day) -> DataFrame:
    """Rows of ``day`` whose key was never reported before it, one per key.

    Same rows as keeping the oldest row per key and then filtering on ``day``,
    but the history is cut to the keys of that one day before it is shuffled.
    """
    today = dedupe(df.filter(F.col(order) == day), keys, order, keep="first")
    probe = today.select(*[F.col(k).alias(f"_p_{k}") for k in keys])
    history = df.filter(F.col(order).isNull() | (F.col(order) < day)).select(*keys)
    seen = history.join(probe, same_keys(keys, "_p_"), "left_semi").distinct()
    seen = seen.select(*[F.col(k).alias(f"_p_{k}") for k in keys])
    return today.join(seen, same_keys(keys, "_p_"), "left_anti")
