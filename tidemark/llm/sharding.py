"""Sharding by fixed virtual slots.

Every record hashes into one of a few thousand slots, once and for all. Bytes
are summed per slot, and a versioned table maps slots to shards. Balancing and
growth edit that table; records never change their slot.

Defined results: a NULL text counts no bytes and has the checksum of an empty
one; NULL keys hash like any value; repeated rows are numbered one by one;
an empty table gives an empty result and an even map; extra columns, also with
the names used here, are ignored by ``shard_rows``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir, settle

N_SLOTS = 4096
COPY_BLOCK = 100_000
_STATE = "struct<loads:array<struct<load:bigint,shard:int>>,placed:array<int>>"


def virtual_slot(keys: list[Column], n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_slots)).cast("int")


def slot_weights(df: DataFrame, size: str, rows: Column, n_slots: int = N_SLOTS) -> DataFrame:
    """Bytes and rows of every slot, empty slots included; ``n_slots`` rows."""
    sums = df.groupBy("virtual_slot").agg(F.sum(F.col(size) * rows).alias("bytes"), F.sum(rows).alias("rows"))
    slots = df.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return slots.join(sums, "virtual_slot", "left").fillna(0, ["bytes", "rows"])


def _fold(slots: DataFrame, loads: Column, mean: Column, target: Callable[[Column, Column], Column]) -> DataFrame:
    """Walk the slots from large to small, keeping the load of each shard.

    ``slots`` has ``n_slots`` rows (virtual_slot, bytes, shard), so one array
    holds them all. ``target(state, slot)`` names the shard that takes a slot;
    it may use the column ``mean``.
    """
    heavy = F.reverse(F.sort_array(F.collect_list(F.struct("bytes", F.negative("virtual_slot").alias("key"), "shard"))))
    row = slots.agg(heavy.alias("heavy")).withColumns({"mean": mean, "loads": loads})

    def place(state: Column, x: Column) -> Column:
        to = target(state, x)
        moved = F.transform(
            state["loads"],
            lambda s: F.struct(
                (
                    s["load"]
                    + F.when(s["shard"] == to, x["bytes"]).otherwise(0)
                    - F.when(s["shard"] == x["shard"], x["bytes"]).otherwise(0)
                ).alias("load"),
                s["shard"].alias("shard"),
            ),
        )
        return F.struct(moved.alias("loads"), F.concat(state["placed"], F.array(to)).alias("placed")).cast(_STATE)

    start = F.struct("loads", F.array().cast("array<int>").alias("placed")).cast(_STATE)
    done = row.select("heavy", F.aggregate("heavy", start, place)["placed"].alias("placed"))
    return done.select(F.inline(F.arrays_zip("heavy", "placed"))).select(
        F.negative("heavy.key").cast("int").alias("virtual_slot"), F.col("placed").alias("shard")
    )


def build_map(weights: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map: the largest slot first, each to the lightest shard."""
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.lit(0).cast("bigint").alias("load"), s.alias("shard")))
    slots = weights.select("virtual_slot", "bytes", F.lit(-1).alias("shard"))
    placed = _fold(slots, loads, F.lit(0.0), lambda state, x: F.array_min(state["loads"])["shard"])
    return placed.withColumn("version", F.lit(1))


def rebalance(current: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version of the map for new weights or more shards.

    A slot moves only from a shard above the mean to the lightest one, and only
    if that one stays lighter than the giver was; all others stay in place.
    """
    slots = weights.join(current.select("virtual_slot", "shard"), "virtual_slot")
    sums = slots.groupBy("shard").agg(F.sum("bytes").alias("load"))
    all_shards = current.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    loads = (
        all_shards.join(sums, "shard", "left")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("load", F.lit(0)).alias("load"), "shard"))))
        .scalar()
    )
    mean = weights.agg((F.sum("bytes") / shards)).scalar()

    def target(state: Column, x: Column) -> Column:
        light = F.array_min(state["loads"])
        own = F.filter(state["loads"], lambda s: s["shard"] == x["shard"])[0]["load"]
        return F.when((own > F.col("mean")) & (light["load"] + x["bytes"] < own), light["shard"]).otherwise(x["shard"])

    version = current.agg(F.max("version") + 1).scalar()
    return _fold(slots.select("virtual_slot", "bytes", "shard"), loads, mean, target).withColumn("version", version.cast("int"))


def write_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the stored map; earlier versions stay readable."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, by default the newest."""
    maps = spark.read.parquet(path)
    wanted = F.lit(version) if version is not None else maps.agg(F.max("version")).scalar()
    return maps.filter(F.col("version") == wanted)


def shard_rows(df: DataFrame, key: str, text: str, shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """Give every record its virtual slot, its shard and its place there.

    Columns: key, size (text bytes plus 8), text_crc32, virtual_slot, shard,
    slot (0-based place in the shard, without gaps) and map_version. Only these
    narrow columns are shuffled. Identical records are folded with a count
    before that; their copies are then dealt over the slots behind their own, one
    each (or evenly, if there are more of them than slots), so that many copies
    of a record spread over all shards like other records. Places come from
    the rows of the slots before (``n_slots`` rows, hence the broadcast) and a
    window inside one slot; raise ``n_slots`` with the row count.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    names = [key, "size", "text_crc32"]
    folded = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    each, more = F.call_function("div", F.col("_n"), F.lit(n_slots)), F.col("_n") % n_slots
    behind = F.explode(F.sequence(F.lit(0), (F.least(F.col("_n"), F.lit(n_slots)) - 1).cast("int")))
    own = F.pmod(virtual_slot([F.col(c) for c in names], n_slots) + F.col("_i"), F.lit(n_slots)).cast("int")
    dealt = folded.withColumn("_i", behind).select(*names, own.alias("virtual_slot"), (each + (F.col("_i") < more).cast("long")).alias("_n"))
    slotted = settle(dealt, "slotted")
    weights = settle(slot_weights(slotted, "size", F.col("_n"), n_slots), "weights")
    path = scratch_dir(spark, "slot_map")
    write_map(build_map(weights, shards), path)
    slot_map = read_map(spark, path)
    in_shard = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = weights.join(slot_map, "virtual_slot").select(
        "virtual_slot", "shard", F.col("version").alias("map_version"), F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("virtual_slot").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        slotted.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPY_BLOCK).cast("long"))))
    )
    first = F.col("_start") + F.col("_before") + F.col("_block")
    last = F.col("_start") + F.col("_before") + F.least(F.col("_block") + COPY_BLOCK, F.col("_n")) - 1
    return placed.select(*names, "virtual_slot", "shard", F.explode(F.sequence(first, last)).alias("slot"), "map_version")
