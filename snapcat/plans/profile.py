"""Silver profiling: the calibration view of the metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapcat.functions import metrics
from snapcat.model import SNAPSHOT
from snapcat.operators.aggregates import GRID, is_recent
from snapcat.operators.joins import snapshot_grid_join
from snapcat.operators.windows import exact_median_cadence, release_gaps

PROFILED = ("recent_releases_12m", "median_cadence_days", "growth_pct", "momentum_index")


def profile_snapshot(artists: DataFrame, albums: DataFrame, tracks: DataFrame) -> DataFrame:
    """Per artist and snapshot: counts with compilations, exact cadence, scores, index.

    Unlike the fact, albums count whether released or not, rows are not made
    distinct, the median averages the middle pair and the index is not clamped.
    """

    def of_type(kind: str, name: str):
        return F.count(F.when(F.col("album_type") == kind, 1)).alias(name)

    album_part = albums.groupBy(*GRID).agg(
        of_type("album", "total_albums"),
        of_type("single", "total_singles"),
        of_type("compilation", "total_compilations"),
        F.count(F.when(is_recent(), 1)).alias("recent_releases_12m"),
    )
    track_part = tracks.groupBy(*GRID).agg(F.count(F.lit(1)).alias("total_tracks"))
    names = artists.groupBy(*GRID).agg(F.max("artist_name").alias("artist_name"))
    counts = ("total_albums", "total_singles", "total_compilations", "total_tracks", "recent_releases_12m")
    base = snapshot_grid_join(
        artists, [names, album_part, track_part, exact_median_cadence(release_gaps(albums))], zero_filled=counts
    )

    # Only the directly preceding snapshot counts here: an artist that skipped it
    # starts over.
    history = Window.partitionBy("artist_id").orderBy(SNAPSHOT)
    position = artists.select(SNAPSHOT).distinct().withColumn(
        "ordinal", F.row_number().over(Window.orderBy(SNAPSHOT))
    )
    # One row per snapshot day: bounded by the calendar, so broadcasting is safe,
    # while a shuffle on the snapshot would gather a whole snapshot in one task.
    placed = base.join(F.broadcast(position), SNAPSHOT)
    adjacent = F.lag("ordinal").over(history) == F.col("ordinal") - 1
    previous = F.when(adjacent, F.lag("total_tracks").over(history))
    cadence, growth = F.col("median_cadence_days"), F.col("growth_pct")
    recent = F.col("recent_releases_12m")
    return placed.withColumn("growth_pct", metrics.growth_pct(F.col("total_tracks"), previous)).select(
        "artist_id", SNAPSHOT, "artist_name", *counts,
        F.round(cadence, 1).alias("median_cadence_days"),
        "growth_pct",
        F.round(metrics.score_recent(recent), 1).alias("s_recent"),
        F.round(metrics.score_growth(growth), 1).alias("s_growth"),
        F.round(metrics.score_cadence(cadence), 1).alias("s_cadence"),
        F.round(metrics.momentum_raw(recent, growth, cadence), 2).alias("momentum_index"),
    )
