"""Writers and incremental loads. Each function that writes says so; reads
back go through the declared schema."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedupe import dedupe
from tidemark.operators.joins import same_keys


def write_table(
    df: DataFrame,
    name: str,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> None:
    """Save as an external table at ``path``."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name, path=path)


def write_path(
    df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    writer = df.write.format(fmt).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_partitioned_csv(df: DataFrame, by: str, path: str) -> None:
    """CSV with header, one folder per value of ``by``."""
    df.write.mode("overwrite").partitionBy(by).option("header", "true").csv(path)


def archive_raw(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Store the input as it came and return the stored copy."""
    df.write.format(fmt).mode("errorifexists").save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet") -> bool:
    """Create an empty table if it is missing; says whether it did."""
    if spark.catalog.tableExists(name):
        return False
    spark.createDataFrame([], schema).write.format(fmt).saveAsTable(name)
    return True


def existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows stored at ``path``; none if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_if_absent(df: DataFrame, path: str, key: str) -> bool:
    """Append unless any incoming key is stored already; says whether rows
    were written."""
    stored = existing(df.sparkSession, path, df.schema).select(key)
    if not stored.join(df.select(key).distinct(), key, "left_semi").isEmpty():
        return False
    df.write.mode("append").parquet(path)
    return True


def unseen(staging: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Staging rows whose key the target lacks, one row per key.

    The staging shrinks to one row per key first. Keys without a NULL are then
    compared by plain equality, which reuses that partitioning, so each side
    moves once; keys with a NULL, if the schema allows any, go a null-safe way
    of their own that reads only such rows.
    """
    order = next((c for c in staging.columns if c not in keys), keys[0])
    once = dedupe(staging, keys, order, keep="first")
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    fresh = once.filter(whole).join(target.filter(whole).select(*keys), keys, "left_anti").select(*staging.columns)
    if not any(staging.schema[k].nullable for k in keys):
        return fresh
    stored = target.filter(~whole).select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    return fresh.unionByName(once.filter(~whole).join(stored, same_keys(keys, "_t_"), "left_anti"))


def bucket_column(buckets: int) -> str:
    return f"bucket_of_{buckets}"


def key_bucket(keys: list[str], buckets: int) -> Column:
    """The folder a key belongs to, of ``buckets``."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def append_new(staging: DataFrame, path: str, keys: list[str], within: str | None = None, buckets: int | None = None) -> None:
    """Insert only unseen keys. A second run with the same rows adds nothing.

    Two ways limit what is read of the target. ``within`` names a column, such as
    an event time, that repeats of a key share: rows outside the lowest and
    highest staged value are skipped by row group. ``buckets`` lays the target out
    in that many folders by key hash; only folders of staged keys are opened. A
    target keeps its number of buckets.
    """
    spark = staging.sparkSession
    schema = staging.schema
    if buckets:
        column = bucket_column(buckets)
        staged = staging.agg(F.collect_set(key_bucket(keys, buckets))).first()[0]  # at most ``buckets`` numbers
        layout = T.StructType([*schema.fields, T.StructField(column, T.IntegerType())])
        target = existing(spark, path, layout).filter(F.col(column).isin(staged)).select(*schema.names)
    else:
        target = existing(spark, path, schema)
    if within:
        lo, hi = (staging.agg(f(within)).scalar() for f in (F.min, F.max))
        target = target.filter(F.col(within).between(lo, hi) | F.col(within).isNull())
    fresh = unseen(staging, target, keys)
    if buckets:
        # the new rows of a folder are gathered; a large folder may be split
        fresh = fresh.withColumn(column, key_bucket(keys, buckets)).hint("rebalance", column)
        fresh.write.mode("append").partitionBy(column).parquet(path)
    else:
        fresh.write.mode("append").parquet(path)


def stage_then_load(
    df: DataFrame, stage_path: str, target_path: str, keys: list[str], within: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Overwrite the stage, insert its unseen rows, return the target.
    ``within`` and ``buckets`` as in ``append_new``."""
    df.write.mode("overwrite").parquet(stage_path)
    staged = df.sparkSession.read.schema(df.schema).parquet(stage_path)
    append_new(staged, target_path, keys, within, buckets)
    return existing(df.sparkSession, target_path, df.schema).select(*df.columns)


def verify_written(df: DataFrame, path: str) -> DataFrame:
    """Compare ``df`` with what is stored at ``path``, counting duplicates:
    one row (source_rows, stored_rows, missing_rows, extra_rows, passed)."""
    return verify_copies(df, {path: path}).drop("copy")


def verify_copies(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """``verify_written`` for several copies of ``df``, named in column ``copy``.

    Rows of all sides are counted per value in one aggregate, so the source moves
    once however many copies there are."""
    sides = ["_s", *[f"_t{i}" for i in range(len(paths))]]

    def marked(rows: DataFrame, side: str) -> DataFrame:
        return rows.withColumns({s: F.lit(int(s == side)) for s in sides})

    stored = [df.sparkSession.read.schema(df.schema).parquet(p) for p in paths.values()]
    every = reduce(DataFrame.unionByName, [marked(rows, s) for rows, s in zip([df, *stored], sides)])
    counted = every.groupBy(*df.columns).agg(*[F.sum(s).alias(s) for s in sides])

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(x), F.lit(0))

    def surplus(a: str, b: str) -> Column:
        return total(F.greatest(F.col(a) - F.col(b), F.lit(0)))

    found = [
        F.struct(
            F.lit(name).alias("copy"),
            total(F.col("_s")).alias("source_rows"),
            total(F.col(t)).alias("stored_rows"),
            surplus("_s", t).alias("missing_rows"),
            surplus(t, "_s").alias("extra_rows"),
        )
        for name, t in zip(paths, sides[1:])
    ]
    rows = counted.agg(F.array(*found).alias("_rows")).select(F.inline("_rows"))
    return rows.withColumn("passed", (F.col("missing_rows") == 0) & (F.col("extra_rows") == 0))


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in one dataset and not the other, duplicates counted, with the
    side they are on."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(
        right.exceptAll(left).withColumn("side", F.lit("right"))
    )
