"""Names for helper columns beside those of any input."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while name in have:
        name += "_"
    return name
