"""Bronze: typed rows with lineage."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapcat.model import DEALT, ENTITIES, SEEN, SNAPSHOT
from snapcat.session import scratch_path
from snapcat.sources.raw import CORRUPT, array_elements, corrupt_array_split, scan_raw_json
from snapcat.sources.tables import clear_quarantine, write_quarantine, write_snapshot

DEFAULT_SOURCE = "catalog-api"
#: Bronze is laid out by snapshot and landing batch; a batch load has a number that no stream uses.
BATCH, BATCH_LOAD = "landing_batch", -1

ARTIST_COLUMNS = ("artist_id", "artist_name", "external_uri", "image_url", "genres")
ALBUM_COLUMNS = (
    "album_id", "album_name", "album_type", "release_date", "release_date_precision", "total_tracks",
    "artist_id", "artist_name", "external_uri", "image_url",
)
TRACK_COLUMNS = (
    "track_id", "track_name", "duration_ms", "explicit", "track_number", "disc_number",
    "album_id", "artist_id", "external_uri",
)


def _typed(
    raw: DataFrame, columns: tuple[str, ...], cleaned: Mapping[str, Column], source: str
) -> DataFrame:
    return raw.select(
        *(cleaned[c].alias(c) if c in cleaned else F.col(c) for c in columns),
        F.try_to_timestamp(F.col("extracted_at")).alias("extracted_at"),
        F.col(SNAPSHOT).try_cast("date").alias(SNAPSHOT),
        F.lit(source).alias("source"),
        F.current_timestamp().alias("ingestion_timestamp"),
        # Rows that stand for several snapshots keep saying which.
        *(c for c in (SEEN, DEALT) if c in raw.columns),
    )


def _trim(*names: str) -> dict[str, Column]:
    return {name: F.trim(F.col(name)) for name in names}


def bronze_artists(raw: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    return _typed(raw, ARTIST_COLUMNS, _trim("artist_id", "artist_name"), source)


def bronze_albums(raw: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    return _typed(raw, ALBUM_COLUMNS, _trim("album_id", "album_name", "artist_id"), source)


def bronze_tracks(raw: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    defaults = {
        "disc_number": F.coalesce("disc_number", F.lit(1)),
        "explicit": F.coalesce("explicit", F.lit(False)),
    }
    return _typed(raw, TRACK_COLUMNS, _trim("track_id", "track_name", "album_id", "artist_id") | defaults, source)


TO_BRONZE = {"artists": bronze_artists, "albums": bronze_albums, "tracks": bronze_tracks}


def to_bronze(entity: str, raw: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Bronze form of one entity; an unknown entity is an error."""
    if entity not in TO_BRONZE:
        raise ValueError(f"unknown entity {entity!r}, expected one of {ENTITIES}")
    return TO_BRONZE[entity](raw, source)


def counted(df: DataFrame, name: str, write: Callable[[DataFrame], object]) -> int:
    """Rows that ``write`` wrote, counted by the write itself instead of a second scan."""
    observed = Observation(name)
    write(df.observe(observed, F.count(F.lit(1)).alias("n")))
    return observed.get["n"]


def write_counted(df: DataFrame, path: str, name: str, partition_by: tuple[str, ...] = (SNAPSHOT,)) -> int:
    """Write one snapshot of a table and return its rows."""
    return counted(df, name, lambda rows: write_snapshot(rows, path, partition_by, gather=False))


MALFORMED = "malformed_json"


def _good_elements(
    spark: SparkSession, raw_root: str, entity: str, snapshot: str, quarantine: str, field_aliases: Mapping[str, str] | None
) -> DataFrame:
    """Rows of the good elements, after the bad ones are in quarantine; files are parsed once."""
    elements = array_elements(spark, raw_root, entity, snapshot, field_aliases)
    path = scratch_path(spark, f"elements-{entity}")
    elements.write.parquet(path)
    good, bad = corrupt_array_split(spark.read.schema(elements.schema).parquet(path))
    rejected = bad.withColumnRenamed(CORRUPT, "record").withColumns({
        SNAPSHOT: F.to_date(F.lit(snapshot)), "dq_rule": F.lit(MALFORMED), "dq_reason": F.lit("element is no object of the schema"),
        "quarantined_at": F.current_timestamp()})
    if rejected.isEmpty():
        clear_quarantine(spark, quarantine, snapshot, MALFORMED)
    else:
        write_quarantine(rejected, quarantine)
    return good


def bronze_snapshot(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    snapshot: str,
    multi_line: bool = True,
    field_aliases: Mapping[str, str] | None = None,
    source: str = DEFAULT_SOURCE,
    quarantine_root: str | None = None,
) -> dict[str, int]:
    """Raw -> Bronze for the three entities of a snapshot; rows written per entity.

    The layout is that of incremental landing, so both may feed one table.  With ``quarantine_root`` every element of a
    JSON array is judged alone: good ones land, others go to ``<quarantine_root>/<entity>`` with their file and
    position (a rerun replaces them), and a damaged file costs no good element.
    """
    counts = {}
    for entity in ENTITIES:
        if quarantine_root is None:
            raw = scan_raw_json(spark, raw_root, entity, snapshot, multi_line, field_aliases)
        else:
            raw = _good_elements(spark, raw_root, entity, snapshot, f"{quarantine_root}/{entity}", field_aliases)
        rows = to_bronze(entity, raw, source).withColumn(BATCH, F.lit(BATCH_LOAD))
        counts[entity] = write_counted(rows, f"{bronze_root}/{entity}", f"bronze_{entity}", (SNAPSHOT, BATCH))
    return counts
