"""Gold: four dimensions and the periodic-snapshot fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.functions import metrics
from snapcat.model import ENTITIES, SNAPSHOT
from snapcat.operators import aggregates as A
from snapcat.operators import windows as W
from snapcat.operators.dedupe import scd1_by_keys, scd1_latest
from snapcat.operators.joins import snapshot_grid_join
from snapcat.plans.bronze import counted, write_counted
from snapcat.session import scratch_path
from snapcat.sources.tables import generate_calendar, scan_snapshot, table_or_none, write_dimension, write_snapshot

COUNTS = ("total_albums", "total_tracks", "total_singles", "recent_releases_12m")


def dim_date(spark: SparkSession, start: str = "1950-01-01", end: str = "2030-12-31") -> DataFrame:
    """Calendar dimension over a fixed range."""
    return calendar_attributes(generate_calendar(spark, start, end))


def calendar_attributes(days: DataFrame) -> DataFrame:
    """Calendar attributes of the days in ``full_date``."""
    day = F.col("full_date")
    weekday = metrics.iso_weekday(day)
    return days.select(
        metrics.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )


def _stamped(df: DataFrame, *columns) -> DataFrame:
    return df.select(*columns, F.current_timestamp().alias("gold_transformed_at"))


def _key(name: str):
    return metrics.surrogate_key(F.col(f"{name}_id")).alias(f"{name}_key")


def artist_attributes(rows: DataFrame) -> DataFrame:
    """Dimension columns of Silver rows, one per artist."""
    return _stamped(rows, _key("artist"), "artist_id", "artist_name", "genres", "external_uri", "image_url", *_carried(rows))


def album_attributes(rows: DataFrame) -> DataFrame:
    return _stamped(
        rows,
        _key("album"), "album_id", _key("artist"), "artist_id", "album_name", "album_type", "release_date",
        "release_year", "release_month", "release_decade", "release_date_precision", "total_tracks",
        "external_uri", "image_url", *_carried(rows),
    )


def track_attributes(rows: DataFrame) -> DataFrame:
    return _stamped(
        rows,
        _key("track"), "track_id", _key("album"), "album_id", _key("artist"), "artist_id", "track_name",
        "duration_ms", "duration_min", "duration_sec", "explicit", "track_number", "disc_number", "external_uri",
        *_carried(rows),
    )


def _carried(rows: DataFrame) -> list[str]:
    """The origin of a row, where a kept-up dimension asks for it."""
    return [c for c in ("seen_at",) if c in rows.columns]


def dim_artist(silver: DataFrame) -> DataFrame:
    return artist_attributes(scd1_latest(silver, ["artist_id"]))


def dim_album(silver: DataFrame) -> DataFrame:
    return album_attributes(scd1_by_keys(silver, "album_id"))


def dim_track(silver: DataFrame) -> DataFrame:
    return track_attributes(scd1_by_keys(silver, "track_id"))


def snapshot_base(
    artists: DataFrame,
    albums: DataFrame,
    tracks: DataFrame,
    snapshot: str | None = None,
    keys_unique: bool = False,
) -> DataFrame:
    """Base measures per (artist, snapshot).

    With ``keys_unique`` (Silver guarantees it, the gate checks it) the albums
    are reduced once, to release days, which give the counts and the cadence;
    tracks are counted without shuffling their ids.
    """
    if snapshot is not None:
        artists, albums, tracks = (
            df.filter(F.col(SNAPSHOT) == F.to_date(F.lit(snapshot))) for df in (artists, albums, tracks)
        )
    track_totals = A.track_counts(tracks, keys_unique)
    if keys_unique:
        measures = [W.release_summary(A.release_days(albums)), track_totals]
    else:
        measures = [A.album_counts(albums), track_totals, W.median_cadence(W.release_gaps(albums))]
    base = snapshot_grid_join(artists, measures, zero_filled=COUNTS)
    return base.select(*A.GRID, *COUNTS, "median_release_cadence_days")


def _fact(grown: DataFrame) -> DataFrame:
    """Fact columns from base measures with growth."""
    index = metrics.momentum_index(
        F.col("recent_releases_12m"), F.col("catalog_growth_pct"), F.col("median_release_cadence_days")
    )
    return grown.select(
        metrics.surrogate_key(F.col("artist_id")).alias("artist_key"),
        metrics.date_key(F.col(SNAPSHOT)).alias("date_key"),
        "artist_id",
        SNAPSHOT,
        *COUNTS,
        "median_release_cadence_days",
        "catalog_growth_pct",
        index.alias("catalog_momentum_index"),
        F.current_timestamp().alias("gold_transformed_at"),
    )


def fact_artist_snapshot(
    artists: DataFrame,
    albums: DataFrame,
    tracks: DataFrame,
    snapshot: str | None = None,
    keys_unique: bool = False,
) -> DataFrame:
    """Periodic-snapshot fact with growth and the momentum index.

    Growth looks back over all snapshots; a target snapshot is filtered last, so
    it still sees its predecessor.
    """
    fact = _fact(W.growth_pct(snapshot_base(artists, albums, tracks, keys_unique=keys_unique)))
    return fact if snapshot is None else fact.filter(F.col(SNAPSHOT) == F.to_date(F.lit(snapshot)))


def fact_increment(
    artists: DataFrame,
    albums: DataFrame,
    tracks: DataFrame,
    history: DataFrame,
    snapshot: str,
    keys_unique: bool = False,
) -> DataFrame:
    """The same fact rows for one snapshot, reading only that snapshot of Silver.

    The predecessor's track count comes from the fact written earlier
    (``history``), which is smaller than Silver by the size of a catalog.
    """
    day = F.to_date(F.lit(snapshot))
    base = snapshot_base(artists, albums, tracks, snapshot, keys_unique)
    before = history.filter(F.col(SNAPSHOT) < day).groupBy("artist_id").agg(
        F.max_by("total_tracks", SNAPSHOT).alias("previous")
    )
    grown = base.join(before, "artist_id", "left").withColumn(
        "catalog_growth_pct", metrics.growth_pct(F.col("total_tracks"), F.col("previous"))
    )
    return _fact(grown)


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    snapshot: str | None = None,
    keys_unique: bool = False,
    calendar: tuple[str, str] = ("1950-01-01", "2030-12-31"),
) -> dict[str, int]:
    """Silver -> the five Gold tables; rows written per table.

    Dimensions are replaced.  The fact is written for every snapshot, or for one
    on top of the history that is already there; without history the predecessor comes
    from Silver.  A snapshot in the middle changes the growth of the one after it,
    which is written anew as well (and counted).
    """
    artists, albums, tracks = (scan_snapshot(spark, f"{silver_root}/{entity}") for entity in ENTITIES)
    dimensions = {
        "dim_date": dim_date(spark, *calendar),
        "dim_artist": dim_artist(artists),
        "dim_album": dim_album(albums),
        "dim_track": dim_track(tracks),
    }
    rows = {
        name: counted(df, name, lambda out, name=name: write_dimension(out, f"{gold_root}/{name}"))
        for name, df in dimensions.items()
    }
    path = f"{gold_root}/fact_artist_snapshot"
    if snapshot is None:
        fact = fact_artist_snapshot(artists, albums, tracks, keys_unique=keys_unique)
        rows["fact_artist_snapshot"] = counted(fact, "fact", lambda out: write_snapshot(out, path))
    else:
        history = table_or_none(spark, path)
        if history is None:
            fact = fact_artist_snapshot(artists, albums, tracks, snapshot, keys_unique)
            rows["fact_artist_snapshot"] = write_counted(fact, path, "fact")
            return rows
        rows["fact_artist_snapshot"] = 0
        later = history.filter(F.col(SNAPSHOT) > F.to_date(F.lit(snapshot))).agg(F.min(SNAPSHOT)).first()[0]
        for day in filter(None, (snapshot, later and str(later))):
            fact = fact_increment(artists, albums, tracks, scan_snapshot(spark, path), day, keys_unique)
            # Its own history is read while it is written: rows go to a staged table first.
            staged = scratch_path(spark, f"fact-{day}")
            fact.write.parquet(staged)
            rows["fact_artist_snapshot"] += write_counted(spark.read.parquet(staged), path, f"fact_{day}")
    return rows
