"""Streaming queries over the events, which land slice by slice in time order.

Each job runs once per landed slice and goes on from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import inputs
from tidemark.session import scratch_dir
from tidemark.sinks.writers import existing
from tidemark.streaming import jobs
from tidemark.suite.base import query

SLICES = 3
_EVENTS = "select event_id, ts, user_id, event_type, value from events"


def _events(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value"
    )


def _run(spark, df, order: str, start) -> str:
    """Land ``df`` in time slices, run ``start(stream, out, checkpoint)`` after
    each, and return the output folder."""
    landing, out, mark = (scratch_dir(spark, label) for label in ("arrivals", "out", "mark"))
    at = F.unix_micros(order)
    inner = [i / SLICES for i in range(1, SLICES)]
    edges = [None, *df.select(at.cast("double").alias("t")).approxQuantile("t", inner, 0.01), None]
    for lo, hi in zip(edges, edges[1:]):
        part = df if lo is None else df.filter(at >= lo)
        (part if hi is None else part.filter(at < hi)).write.mode("append").parquet(landing)
        start(jobs.file_stream(spark, landing, df.schema), out, mark).awaitTermination()
    return out


def _plain(df):
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _redelivered(events):
    """Errors and purchases arrive a second time, half a day later."""
    again = events.filter(F.col("event_type").isin("error", "purchase")).withColumn(
        "arrival", F.col("ts") + F.expr("interval 12 hours")
    )
    return events.withColumn("arrival", F.col("ts")).unionByName(again)


@query("stream_ingest", _EVENTS)
def stream_ingest(spark, sf_dir):
    events = _events(spark, sf_dir)
    out = _run(spark, events, "ts", jobs.ingest_stream)
    return _plain(existing(spark, out, events.schema))


@query("stream_incremental_insert", _EVENTS)
def stream_incremental_insert(spark, sf_dir):
    events = _events(spark, sf_dir)
    out = _run(
        spark,
        _redelivered(events),
        "arrival",
        lambda stream, out, mark: jobs.incremental_insert_stream(
            stream.drop("arrival"), out, mark, ["event_id"], within="ts"
        ),
    )
    return _plain(existing(spark, out, events.schema))


@query("stream_first_seen", _EVENTS)
def stream_first_seen(spark, sf_dir):
    events = _events(spark, sf_dir)

    def start(stream, out, mark):
        return jobs.ingest_stream(jobs.first_seen(stream.drop("arrival"), ["event_id"], "ts", "2 days"), out, mark)

    out = _run(spark, _redelivered(events), "arrival", start)
    return _plain(existing(spark, out, events.schema))


@query(
    "stream_daily_counts",
    "select cast(ts as date) as day, event_type, count(*) as n from events group by 1, 2",
)
def stream_daily_counts(spark, sf_dir):
    out = _run(
        spark,
        _events(spark, sf_dir),
        "ts",
        lambda stream, out, mark: jobs.daily_counts_stream(stream, out, mark, "ts", "event_type", "1 day"),
    )
    return jobs.latest_counts(spark, out, "event_type")
