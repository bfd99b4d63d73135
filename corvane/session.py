"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings; all can be set on a session that somebody else started.
RUNTIME_SETTINGS = {
    # A message may repeat a key; the last one wins, as in most JSON readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    # Split a hot key's partition even when the next step then needs a shuffle
    # of its own: otherwise join output partitioned by user would feed the
    # (user, token) aggregation of a hot user to a single task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Python workers get batches bounded by bytes too: ten thousand long texts are too many.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Write the few status folders of an ingest side by side, without a sort.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Start (or fetch) a configured session; `master` is left to spark-submit by default."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


# Folders handed out by this process and not yet released.
_handed_out: list[str] = []


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name for one run's tables, on storage that every executor sees.

    `spark.checkpoint.dir` names it; where that is unset, as in tests, the
    folder lies below the warehouse, which Spark shares by definition. `release`
    removes what was written there once its results have been taken.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediate"
    _handed_out.append(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _handed_out[-1]


def release(spark: SparkSession) -> int:
    """Remove the folders handed out so far; their number.

    For the end of a job: DataFrames that still read from them fail afterwards.
    Spark's own file system is asked, so any shared storage will do.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    removed = 0
    while _handed_out:
        path = hadoop.Path(_handed_out.pop())
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed
