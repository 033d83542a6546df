"""Snapshot ledger: which snapshots has which job processed.

The ledger is an append-only table, so a commit is one small file and concurrent
writers never rewrite each other.  Reading folds it to the latest entry per
(job, snapshot).  A reset is an entry too: everything before it is ignored.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.model import SNAPSHOT

LEDGER_SCHEMA = "job_name string, snapshot_date date, status string, committed_at timestamp, metadata string"
NEVER = "1970-01-01"
_RESET = "RESET"


def ledger_entries(spark: SparkSession, path: str) -> DataFrame:
    """All entries; a ledger that was never written is empty."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def ledger_state(entries: DataFrame) -> DataFrame:
    """Latest entry per (job, snapshot) that no later reset has cancelled."""
    resets = entries.filter(F.col("status") == _RESET).groupBy("job_name").agg(
        F.max("committed_at").alias("reset_at")
    )
    # NULL job name on a reset entry means every job.
    everyone = resets.filter(F.col("job_name").isNull()).select("reset_at")
    live = entries.filter(F.col("status") != _RESET).join(resets, "job_name", "left").filter(
        F.col("reset_at").isNull() | (F.col("committed_at") > F.col("reset_at"))
    )
    global_reset = everyone.agg(F.max("reset_at").alias("m")).scalar()
    live = live.filter(global_reset.isNull() | (F.col("committed_at") > global_reset))
    return live.groupBy("job_name", SNAPSHOT).agg(
        F.max_by("status", "committed_at").alias("status"),
        F.max("committed_at").alias("committed_at"),
        F.max_by("metadata", "committed_at").alias("metadata"),
    )


def job_progress(entries: DataFrame) -> DataFrame:
    """Per job: last processed snapshot (the newest, not the latest commit) and count."""
    return ledger_state(entries).groupBy("job_name").agg(
        F.max(SNAPSHOT).alias("last_processed_date"),
        F.max("committed_at").alias("last_processed_at"),
        F.count(F.lit(1)).alias("processed_snapshots"),
    )


def commit_snapshot(
    spark: SparkSession,
    path: str,
    job: str,
    snapshot: str,
    status: str = "SUCCESS",
    metadata: str | None = None,
) -> bool:
    """Record a processed snapshot; False if the same entry is already there."""
    same = ledger_state(ledger_entries(spark, path)).filter(
        (F.col("job_name") == job)
        & (F.col(SNAPSHOT) == F.to_date(F.lit(snapshot)))
        & (F.col("status") == status)
        & F.col("metadata").eqNullSafe(F.lit(metadata))
    )
    if not same.isEmpty():
        return False
    _append(spark, path, job, date.fromisoformat(snapshot), status, metadata)
    return True


def reset_ledger(spark: SparkSession, path: str, job: str | None = None) -> None:
    """Forget one job, or every job."""
    _append(spark, path, job, None, _RESET, None)


def _append(spark, path, job, snapshot, status, metadata) -> None:
    now = datetime.now(timezone.utc)
    entry = spark.createDataFrame([(job, snapshot, status, now, metadata)], LEDGER_SCHEMA)
    entry.coalesce(1).write.mode("append").parquet(path)


def last_processed(spark: SparkSession, path: str, job: str, default: str = NEVER) -> str:
    row = job_progress(ledger_entries(spark, path)).filter(F.col("job_name") == job).first()
    return row["last_processed_date"].isoformat() if row else default


def is_processed(spark: SparkSession, path: str, job: str, snapshot: str) -> bool:
    hit = ledger_state(ledger_entries(spark, path)).filter(
        (F.col("job_name") == job) & (F.col(SNAPSHOT) == F.to_date(F.lit(snapshot)))
    )
    return not hit.isEmpty()


def pending_snapshots(table: DataFrame, entries: DataFrame, job: str) -> DataFrame:
    """Snapshots present in ``table`` that ``job`` has not processed, oldest first."""
    done = ledger_state(entries).filter(F.col("job_name") == job).select(SNAPSHOT)
    return table.select(SNAPSHOT).distinct().join(done, SNAPSHOT, "left_anti").orderBy(SNAPSHOT)
