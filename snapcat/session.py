"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Cluster-neutral settings: nothing here fixes a partition count, because the
# right number grows with the data; AQE coalesces and splits from real sizes.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even if that costs one more exchange later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes a few snapshots keeps their files open instead of sorting its rows by snapshot.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "snapcat", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the recommended settings; keyword settings win.

    Dots in setting names are written as double underscores
    (``spark__sql__shuffle__partitions="64"``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_recommended(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    A machine-local folder is used only when the session names none and runs in
    a single local JVM (tests); on a cluster that is an error, not a fallback.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="snapcat-")
    return _local_dirs[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
