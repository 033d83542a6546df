"""Parquet tables: scans, sinks, views, footprint."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.functions import metrics
from snapcat.model import SNAPSHOT

GOLD_TABLES = ("dim_date", "dim_artist", "dim_album", "dim_track", "fact_artist_snapshot")


def scan_snapshot(spark: SparkSession, path: str, snapshot: str | None = None) -> DataFrame:
    """A snapshot-partitioned table, or one snapshot of it (pruned to its folder)."""
    df = spark.read.parquet(path)
    return df if snapshot is None else df.filter(F.col(SNAPSHOT) == F.to_date(F.lit(snapshot)))


def latest_snapshot_filter(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Rows of the newest snapshot, found by a one-value subquery.

    ``source`` may be any cheaper table that holds the same snapshots.
    """
    newest = (source if source is not None else df).agg(F.max(SNAPSHOT).alias("newest")).scalar()
    return df.filter(F.col(SNAPSHOT) == newest)


def write_snapshot(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (SNAPSHOT,),
    gather: bool = True,
    max_records_per_file: int = 5_000_000,
) -> str:
    """Overwrite only the partitions present in ``df``.

    ``gather`` brings the rows of a partition together before the write, so many
    snapshots do not multiply the number of files; AQE splits a snapshot that is
    too big for one task.  A frame that holds a single snapshot does not need the
    extra shuffle.
    """
    rows = df.hint("rebalance", *partition_by) if gather else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return path


def write_dimension(df: DataFrame, path: str) -> str:
    """Replace an unpartitioned table."""
    df.write.mode("overwrite").parquet(path)
    return path


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None if nothing was ever written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def write_quarantine(rejected: DataFrame, path: str) -> str:
    """Write stamped rejects; a rerun replaces what it wrote for the same snapshot and rule."""
    return write_snapshot(rejected, path, (SNAPSHOT, "dq_rule"))


def clear_quarantine(spark: SparkSession, path: str, snapshot: str, rule: str) -> None:
    """Empty the partition of a rerun that rejects nothing any more."""
    kept = table_or_none(spark, path)
    if kept is not None and not kept.filter((F.col(SNAPSHOT) == F.to_date(F.lit(snapshot))) & (F.col("dq_rule") == rule)).isEmpty():
        nothing = kept.drop(SNAPSHOT, "dq_rule").limit(0)
        nothing.write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}={snapshot}/dq_rule={rule}")


def write_dq_report(results: DataFrame, summary: DataFrame, path: str) -> tuple[str, str]:
    """Rule results and their summary, one partition per snapshot."""
    return write_snapshot(results, f"{path}/results"), write_snapshot(summary, f"{path}/summary")


def register_gold_views(spark: SparkSession, gold_root: str) -> tuple[str, ...]:
    """Temporary views over the five gold tables; partitions come from the folders."""
    for name in GOLD_TABLES:
        spark.read.parquet(f"{gold_root.rstrip('/')}/{name}").createOrReplaceTempView(name)
    return GOLD_TABLES


def generate_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """One row per day between the first and the last value of ``column``."""
    bounds = df.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
    return bounds.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date")
    )


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(file_count, bytes) of a folder from its listing: no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def parquet_footprint(spark: SparkSession, folders: Mapping[tuple[str, str], str], base_layer: str) -> DataFrame:
    """Rows, files and bytes per (entity, layer) of Parquet folders, and the saving against ``base_layer``.

    Sizes come from the listing and rows from the footers: no column of any row is read.
    """
    parts = []
    for (entity, layer), path in folders.items():
        rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
        # One row meets one row.
        parts.append(file_sizes(spark, path).withColumn("row_count", rows.scalar()).select(
            F.lit(entity).alias("entity"), F.lit(layer).alias("layer"), "row_count", "file_count", "bytes"))
    sizes = reduce(DataFrame.unionByName, parts)
    base = sizes.filter(F.col("layer") == base_layer).select("entity", F.col("bytes").alias("base_bytes"))
    return sizes.join(base, "entity", "left").withColumn(
        "saving_pct", metrics.pct(F.col("base_bytes") - F.col("bytes"), F.col("base_bytes"), 1))


def _layer_size(df: DataFrame, entity: str, layer: str, lines: bool = False) -> DataFrame:
    label = F.lit(entity).alias("entity"), F.lit(layer).alias("layer")
    if lines:
        # Every line has its end.
        return df.agg(*label, F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(F.octet_length("value").cast("bigint") + 1), F.lit(0)).alias("bytes"))
    # Per file first: a file's size must be counted once, its rows all.
    per_file = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).groupBy("path").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        *label,
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
    )


def storage_footprint(
    layers: Mapping[tuple[str, str], DataFrame],
    base_layer: str,
    expected_rows: Mapping[str, int] | None = None,
    line_layers: Collection[str] = (),
) -> DataFrame:
    """Rows and bytes per (entity, layer), saving against ``base_layer``, row check.

    Every frame must be a plain file scan.  A total over all entities is added.  Frames of ``line_layers`` are scans of
    text files: their size is that of the lines as plain text, whatever codec the files are kept under.
    """
    sizes = reduce(
        DataFrame.unionByName, [_layer_size(df, entity, layer, layer in line_layers) for (entity, layer), df in layers.items()]
    )
    with_total = sizes.unionByName(
        sizes.groupBy("layer").agg(
            F.lit("TOTAL").alias("entity"), F.sum("row_count").alias("row_count"), F.sum("bytes").alias("bytes")
        )
    )
    base = with_total.filter(F.col("layer") == base_layer).select("entity", F.col("bytes").alias("base_bytes"))
    out = with_total.join(base, "entity", "left").withColumn(
        "saving_pct", metrics.pct(F.col("base_bytes") - F.col("bytes"), F.col("base_bytes"), 1)
    )
    if expected_rows:
        expected = F.create_map(*(F.lit(v) for pair in expected_rows.items() for v in pair))
        out = out.withColumn("rows_as_expected", F.col("row_count") == F.try_element_at(expected, F.col("entity")))
    return out
