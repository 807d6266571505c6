"""Dimension tables from nested values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def nested_literal(spark: SparkSession, nested: dict, key: str, inner_ddl: str) -> DataFrame:
    """A Python dict of dicts as rows (key, items map)."""
    return spark.createDataFrame(list(nested.items()), f"{key} string, items map<string, {inner_ddl}>")


def dimension_from_nested(nested: DataFrame, outer: str, inner: str, items: str = "items") -> DataFrame:
    """One row per inner entry: (inner name, outer, value) and the id
    ``inner|outer``."""
    return nested.select(outer, F.explode(items).alias(inner, "value")).withColumn(
        f"{inner.removesuffix('_name')}_id", F.concat_ws("|", inner, outer)
    )


def lat_long(location: Column) -> tuple[Column, Column]:
    """``"lat,long"`` text to two doubles."""
    parts = F.split(location, ",")
    return tuple(F.trim(F.get(parts, F.lit(i))).try_cast("double") for i in (0, 1))


def store_dimension(nested: DataFrame, update_ts: Column) -> DataFrame:
    """State to city to (store_id_code, location, phone_number) entries, as
    the store dimension."""
    flat = nested.select("state", F.explode("items").alias("city", "v"))
    latitude, longitude = lat_long(F.col("v.location"))
    return flat.select(
        F.col("v.store_id_code").alias("store_id_code"),
        "city",
        "state",
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        F.col("v.phone_number").alias("phone_number"),
        update_ts.alias("update_timestamp"),
    )
