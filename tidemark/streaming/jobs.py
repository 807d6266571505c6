"""File arrival as Structured Streaming.

Every job takes what is there (``availableNow``) and stops; a restart with the
same checkpoint goes on where it left off. Sinks are Parquet folders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.writers import append_new

#: Batches between two snapshots of daily counts.
COMPACT_EVERY = 20


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New files under ``path``, each read once, oldest first."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest_stream(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to ``out``; the file sink commits each batch once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def incremental_insert_stream(
    stream: DataFrame, out: str, checkpoint: str, keys: list[str], within: str | None = None, buckets: int | None = None
) -> StreamingQuery:
    """Insert unseen keys per batch. A replayed batch adds nothing, since its
    keys are stored already. ``within`` and ``buckets`` limit what is read of the
    target (see ``append_new``)."""
    return (
        stream.writeStream.foreachBatch(lambda batch, _: append_new(batch, out, keys, within, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_seen(stream: DataFrame, keys: list[str], time_col: str, delay: str) -> DataFrame:
    """The first arrival per key. State is kept for ``delay`` of event time,
    the longest a repeat may lag behind."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def daily_counts(stream: DataFrame, time_col: str, by: str, delay: str) -> DataFrame:
    """Rows per day and ``by``; rows later than ``delay`` are dropped."""
    return (
        stream.withWatermark(time_col, delay)
        .groupBy(F.window(time_col, "1 day").alias("w"), by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").cast("date").alias("day"), by, "n")
    )


def daily_counts_stream(
    stream: DataFrame, out: str, checkpoint: str, time_col: str, by: str, delay: str, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Write changed counts per batch to ``out/batch=<id>``. A replayed batch
    overwrites its own folder, so results never double. Every
    ``compact_every`` batches those before, which are committed, become a
    snapshot."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        write_counts(batch, out, batch_id)
        if batch_id and batch_id % compact_every == 0:
            compact_counts(batch.sparkSession, out, by, batch_id - 1)

    return (
        daily_counts(stream, time_col, by, delay)
        .writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_counts(batch: DataFrame, out: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")


def _numbered(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers n of the finished folders ``<name>=<n>`` in ``folder``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path(folder)):
        return []
    found = [s.getPath() for s in files.listStatus(path(folder))]
    done = [f.getName() for f in found if f.getName().startswith(f"{name}=") and files.exists(path(f, "_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def _counts_after(spark: SparkSession, out: str, by: str, upto: int | None) -> tuple[DataFrame | None, int]:
    """Rows (day, by, n, batch) of the newest snapshot and the batches behind
    it, up to ``upto``, and that snapshot's number (-1 without one)."""
    snapshots = [n for n in _numbered(spark, f"{out}/snapshots", "upto") if upto is None or n <= upto]
    last = snapshots[-1] if snapshots else -1
    tail = [n for n in _numbered(spark, out, "batch") if n > last and (upto is None or n <= upto)]
    parts = []
    if snapshots:
        parts.append(spark.read.parquet(f"{out}/snapshots/upto={last}"))
    if tail:
        batches = spark.read.option("basePath", out).parquet(*[f"{out}/batch={n}" for n in tail])
        parts.append(batches.select("day", by, "n", F.col("batch").cast("long").alias("batch")))
    return (reduce(DataFrame.unionByName, parts) if parts else None), last


def compact_counts(spark: SparkSession, out: str, by: str, upto: int) -> None:
    """Merge the newest snapshot and the batches up to ``upto``, which must be
    committed, into ``out/snapshots/upto=<n>``. Nothing is deleted or changed in
    place: a replay of an older batch rewrites a folder that is read no more, a
    newer one is not in the snapshot, and an unfinished snapshot is not read."""
    rows, last = _counts_after(spark, out, by, upto)
    if rows is None or last == upto:
        return
    newest = rows.groupBy("day", by).agg(F.max(F.struct("batch", "n")).alias("x"))
    newest.select("day", by, "x.n", "x.batch").write.mode("overwrite").parquet(f"{out}/snapshots/upto={upto}")


def latest_counts(spark: SparkSession, out: str, by: str) -> DataFrame:
    """Current counts: the newest batch's figure per day and ``by``, from the
    newest snapshot and the batches after it."""
    rows, _ = _counts_after(spark, out, by, None)
    if rows is None:
        raise ValueError(f"no counts at {out}")
    return rows.groupBy("day", by).agg(F.max_by("n", "batch").alias("n"))
