"""Incremental landing: new raw files become Bronze exactly once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from snapcat.model import SNAPSHOT, raw_schema
from snapcat.plans.bronze import BATCH, DEFAULT_SOURCE, to_bronze
from snapcat.sources.tables import write_snapshot

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def incremental_landing(
    spark: SparkSession,
    raw_glob: str,
    entity: str,
    bronze_path: str,
    checkpoint: str,
    multi_line: bool = True,
    max_files_per_batch: int | None = None,
    source: str = DEFAULT_SOURCE,
    repeat_key: Sequence[str] | None = None,
    repeat_horizon: str = "30 days",
) -> StreamingQuery:
    """Process all files not seen before, then stop; run it again for later ones.

    A batch owns the partitions (snapshot, batch number), and a replayed batch
    overwrites exactly what its first attempt wrote.  So replays are idempotent,
    files of one snapshot may arrive in different batches, and a late or
    backfilled snapshot is just another partition.  The checkpoint belongs to the
    table: keep both or drop both.  Files are JSON arrays (``multi_line``) or JSON lines.
    A batch load of the same table (``bronze_snapshot``) has a batch number of its own.

    With ``repeat_key`` (columns that name a raw record, such as its link and snapshot) a record that lands
    again, in another file, batch or run, is dropped if its first copy landed within ``repeat_horizon``; the first
    one wins.  Digests of the keys are state in RocksDB, part of the checkpoint (one from before they were digests cannot go on).  The horizon runs on arrival time, so a late or
    backfilled snapshot is never too late itself; a repeat after the horizon lands anew, and Silver's dedupe
    takes it.  Rows with a NULL in the key
    count as repeats only if all their columns are equal.
    """
    reader = spark.readStream.schema(raw_schema(entity)).option("multiLine", multi_line)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def land(batch: DataFrame, batch_id: int) -> None:
        bronze = to_bronze(entity, batch, source).withColumn(BATCH, F.lit(batch_id))
        # A task has a file per snapshot it holds: gathering them would shuffle every row (after the state, once more).
        write_snapshot(bronze, bronze_path, (SNAPSHOT, BATCH), gather=False)

    rows = reader.json(raw_glob)
    if repeat_key is None:
        return _start(rows, land, checkpoint)
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)  # read when the query starts
    try:
        return _start(first_landed(rows, repeat_key, repeat_horizon), land, checkpoint)
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def first_landed(rows: DataFrame, key: Sequence[str], horizon: str) -> DataFrame:
    """The first copy of each record within ``horizon`` of arrival time."""
    # 128 bits of SHA-256 stand for the key in shuffle and state, where it would be held several times over.  The first field tells the two kinds apart.
    gaps = reduce(Column.__or__, (F.col(c).isNull() for c in key))
    named = [F.to_json(F.struct(F.lit(kind).alias("__kind"), *(F.col(c) for c in columns))) for kind, columns in (("row", rows.columns), ("key", key))]
    digest = F.substring(F.unhex(F.sha2(F.when(gaps, named[0]).otherwise(named[1]), 256)), 1, 16)
    marked = rows.withColumns({"__key": digest, "__arrived": F.current_timestamp()}).withWatermark("__arrived", horizon)
    return marked.dropDuplicatesWithinWatermark(["__key"]).drop("__key", "__arrived")


def _start(rows: DataFrame, land, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
