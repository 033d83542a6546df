"""Read functions behind dashboards: filtered, ordered slices of star and marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcat.functions import display
from snapcat.functions.cleaning import duration_minutes
from snapcat.model import SNAPSHOT
from snapcat.operators.joins import track_album_artist_join
from snapcat.plans.marts import mart_artist_activity


def at_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    return df.filter(F.col(SNAPSHOT) == F.to_date(F.lit(snapshot)))


def snapshot_dates(fact: DataFrame) -> DataFrame:
    """Snapshots as text, newest first."""
    return fact.select(F.col(SNAPSHOT).cast("string").alias(SNAPSHOT)).distinct().orderBy(F.desc(SNAPSHOT))


def artist_list(dim_artist: DataFrame) -> DataFrame:
    return dim_artist.select("artist_name").distinct().orderBy(F.col("artist_name").asc_nulls_last())


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def ordered_topn(df: DataFrame, order, n: int) -> DataFrame:
    """First ``n`` rows of a report; each task keeps only its own ``n``."""
    return df.orderBy(*order).limit(n)


def drop_null_sort(df: DataFrame, column: str) -> DataFrame:
    return df.dropna(subset=[column]).orderBy(F.col(column).desc())


def artist_activity_at(fact: DataFrame, dim_artist: DataFrame, snapshot: str) -> DataFrame:
    """Ranks look at one snapshot only, so the fact is filtered before they are made."""
    return mart_artist_activity(at_snapshot(fact, snapshot), dim_artist).orderBy("activity_rank")


def artist_momentum_at(momentum: DataFrame, snapshot: str) -> DataFrame:
    return at_snapshot(momentum, snapshot).orderBy("momentum_rank")


def catalog_growth_all(growth: DataFrame) -> DataFrame:
    return growth.orderBy(F.col(SNAPSHOT).desc_nulls_last(), "expansion_rank")


def release_seasonality_all(seasonality: DataFrame) -> DataFrame:
    return seasonality.orderBy("release_month")


def strategy_distribution(mix: DataFrame, snapshot: str) -> DataFrame:
    """Artists per strategy; ``mix`` is a fact with :func:`release_mix` columns, no rank is needed."""
    return (
        at_snapshot(mix, snapshot)
        .groupBy("catalog_strategy")
        .agg(F.count(F.lit(1)).alias("artist_count"))
        .orderBy(F.desc("artist_count"))
    )


def artist_profile(
    momentum: DataFrame, activity: DataFrame, dim_artist: DataFrame, artist_name: str, snapshot: str
) -> DataFrame:
    """Everything known about one artist at one snapshot."""
    who = dim_artist.filter(F.col("artist_name") == artist_name).select(
        "artist_key", "artist_name", "genres", "external_uri", "image_url"
    )
    act = at_snapshot(activity, snapshot).select(
        "artist_key", "total_albums", "total_singles", "catalog_strategy", "activity_tier"
    )
    scores = at_snapshot(momentum, snapshot).drop("artist_name")
    return who.join(scores, "artist_key").join(act, "artist_key", "left").select(
        "artist_name", "genres", "external_uri", "image_url", SNAPSHOT, "catalog_momentum_index",
        "momentum_rank", "momentum_tier", "volume_score", "growth_score", "cadence_score",
        "recent_releases_12m", "median_release_cadence_days", "catalog_growth_pct", "total_tracks",
        "momentum_delta", "trajectory_direction", "total_albums", "total_singles", "catalog_strategy",
        "activity_tier",
    )


def artist_trajectory(fact: DataFrame, dim_artist: DataFrame, artist_name: str) -> DataFrame:
    """One artist's metrics over all snapshots."""
    who = dim_artist.filter(F.col("artist_name") == artist_name).select("artist_key", "artist_name")
    return fact.join(who, "artist_key").select(
        F.col(SNAPSHOT).cast("string").alias(SNAPSHOT), "artist_name", "total_tracks", "total_albums",
        "total_singles", "catalog_momentum_index", "recent_releases_12m", "median_release_cadence_days",
    ).orderBy(SNAPSHOT)


def artist_discography(
    dim_album: DataFrame, dim_artist: DataFrame, artist_name: str, link_base: str
) -> DataFrame:
    """One artist's releases, newest first, with links."""
    who = dim_artist.filter(F.col("artist_name") == artist_name).select("artist_key")
    return dim_album.join(who, "artist_key").select(
        "album_name", F.col("release_date").cast("string").alias("release_date"), "album_type",
        "total_tracks", "album_id", display.link(link_base, F.col("album_id")).alias("album_url"),
    ).orderBy(F.col("release_date").desc_nulls_last())


def explore_tracks(
    dim_track: DataFrame,
    dim_album: DataFrame,
    dim_artist: DataFrame,
    link_base: str,
    artist_names: Sequence[str] | None = None,
    album_types: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Filtered track list for exploration, newest first; all of it, or the first ``limit`` rows.

    Filters sit on the small tables, below the join with the tracks.
    """
    if artist_names:
        dim_artist = dim_artist.filter(F.col("artist_name").isin(*artist_names))
    if album_types:
        dim_album = dim_album.filter(F.col("album_type").isin(*album_types))
    rows = track_album_artist_join(dim_track, dim_album, dim_artist).select(
        "track_name", "artist_name", "album_name", "album_type",
        F.col("release_date").cast("string").alias("release_date"), "duration_ms",
        duration_minutes(F.col("duration_ms")).alias("duration_min"), "explicit", "disc_number",
        "track_number", display.link(link_base, F.col("track_id")).alias("track_url"),
    )
    # The URL holds the track id: ties resolve the same way on every run.
    order = [F.col("release_date").desc_nulls_last(), F.col("track_number").asc_nulls_last(), F.col("track_url")]
    return rows.orderBy(*order) if limit is None else ordered_topn(rows, order, limit)


def duration_rows(
    dim_track: DataFrame, dim_album: DataFrame, dim_artist: DataFrame, below_ms: int | None = None
) -> DataFrame:
    """Track length in minutes with artist, type and year, for positive lengths below ``below_ms``."""
    valid = dim_track.filter(F.col("duration_ms") > 0)
    if below_ms is not None:
        valid = valid.filter(F.col("duration_ms") < below_ms)
    return track_album_artist_join(valid, dim_album, dim_artist).select(
        "artist_name", "track_name", duration_minutes(F.col("duration_ms")).alias("duration_min"),
        "album_type", F.year("release_date").alias("release_year"), "explicit",
    )


def display_tracks(tracks: DataFrame, link_base: str) -> DataFrame:
    """Presentation text for a track list."""
    return tracks.withColumns({
        "duration_text": display.clock_duration(F.col("duration_ms")),
        "track_url": display.link(link_base, F.col("track_id")),
        "length_compact": display.compact_number(F.col("duration_ms")),
        "length_grouped": display.grouped_number(F.col("duration_ms")),
    })


def display_artists(momentum: DataFrame, activity: DataFrame) -> DataFrame:
    """Presentation text for artists: badges, compact counts, percentages."""
    joined = momentum.select(
        "artist_key", SNAPSHOT, "artist_name", "catalog_momentum_index", "catalog_growth_pct", "total_tracks"
    ).join(
        activity.select("artist_key", SNAPSHOT, "single_pct", "catalog_strategy", "activity_tier"),
        ["artist_key", SNAPSHOT],
    )
    return joined.select(
        "artist_key", SNAPSHOT, "artist_name",
        display.momentum_badge(F.col("catalog_momentum_index")).alias("momentum_badge"),
        display.activity_badge(F.col("activity_tier")).alias("activity_badge"),
        display.strategy_badge(F.col("catalog_strategy")).alias("strategy_badge"),
        display.compact_number(F.col("total_tracks")).alias("tracks_compact"),
        display.percentage_text(F.col("single_pct")).alias("single_share"),
        display.percentage_text(F.col("catalog_growth_pct"), decimals=2).alias("growth"),
    )


def warehouse_health(
    fact: DataFrame,
    dim_artist: DataFrame,
    dim_album: DataFrame,
    dim_track: DataFrame,
    dq_summary: DataFrame,
) -> DataFrame:
    """One row: newest and previous snapshot, table sizes, newest gate status.

    A dimension has one row per key, so rows are counted; the gate's status is read
    from its written summary.  One-row aggregates are stacked and folded, so no cross join is needed.
    """
    per_snapshot = fact.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("n"))
    dates = F.sort_array(F.collect_list(SNAPSHOT), asc=False)
    parts = [
        per_snapshot.agg(
            F.try_element_at(dates, F.lit(1)).cast("string").alias("latest_snapshot"),
            F.try_element_at(dates, F.lit(2)).cast("string").alias("previous_snapshot"),
            F.count(F.lit(1)).alias("total_snapshots"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_facts"),
        ),
        dim_artist.agg(F.count(F.lit(1)).alias("artists_count")),
        dim_album.agg(F.count(F.lit(1)).alias("albums_count")),
        dim_track.agg(F.count(F.lit(1)).alias("tracks_count")),
        dq_summary.agg(F.max_by("overall_status", SNAPSHOT).alias("dq_status")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))
