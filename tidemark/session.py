"""Session set-up and the shared working folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: str | None = None
_MADE: list[str] = []


def get_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings the operators rely on.

    Cluster sizing (executors, memory, shuffle partitions) is left to
    spark-submit; AQE picks partition counts and splits skewed joins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _local_root() -> str:
    """One temporary folder per test process, removed when it ends."""
    global _LOCAL
    if _LOCAL is None:
        _LOCAL = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _LOCAL, ignore_errors=True)
    return _LOCAL


def scratch_dir(spark: SparkSession, label: str = "work") -> str:
    """A new, unique folder every executor can reach, under the cluster's
    ``spark.checkpoint.dir``.

    Only where driver and executors are one local process (tests, benches) may
    the setting be missing; elsewhere that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_root()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def stored_copies() -> int:
    """How many stored copies this process holds."""
    return len(_MADE)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the stored copies this process has made, except the first
    ``since`` and the last ``keep``; call it when what reads them is written."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    doomed = slice(since, len(_MADE) - keep)
    for name in _MADE[doomed]:
        path = hadoop(name)
        path.getFileSystem(conf).delete(path, True)
    del _MADE[doomed]


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` once to the shared folder and return the stored table.

    Used where a later step must see exactly the same rows and partition
    numbers again, also after an executor is lost.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
