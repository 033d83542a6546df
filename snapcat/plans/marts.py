"""Marts over the star: one row per artist and snapshot, or per month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.functions import metrics
from snapcat.model import SNAPSHOT
from snapcat.operators import aggregates as A
from snapcat.operators.joins import fact_dim_join
from snapcat.operators.ranking import rank_global, rank_per_snapshot
from snapcat.operators.windows import prev_value_lag
from snapcat.sources.tables import latest_snapshot_filter

ACTIVITY_COLUMNS = (
    SNAPSHOT, "artist_key", "artist_name", "recent_releases_12m", "total_albums", "total_singles",
    "total_releases", "single_pct", "album_pct", "single_to_album_ratio", "catalog_strategy",
    "activity_rank", "activity_tier",
)
GROWTH_COLUMNS = (
    SNAPSHOT, "artist_key", "artist_name", "prev_tracks", "current_tracks", "net_tracks_added",
    "catalog_growth_pct", "growth_classification", "expansion_rank",
)
SEASON_COLUMNS = (
    "release_month", "month_name", "total_releases", "studio_albums", "singles", "compilations",
    "single_share_pct", "album_share_pct", "volume_rank", "industry_season_archetype",
)
MOMENTUM_COLUMNS = (
    SNAPSHOT, "artist_key", "artist_name", "catalog_momentum_index", "momentum_rank", "momentum_tier",
    "volume_score", "growth_score", "cadence_score", "recent_releases_12m", "median_release_cadence_days",
    "catalog_growth_pct", "total_tracks", "prev_momentum", "momentum_delta", "trajectory_direction",
)
MOMENTUM_LATEST_COLUMNS = tuple(c for c in MOMENTUM_COLUMNS if c not in ("volume_score", "growth_score", "cadence_score"))


def with_artist(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    return fact_dim_join(fact, dim_artist, "artist_key", ["artist_name"])


def release_mix(df: DataFrame, digits: int = 1) -> DataFrame:
    """Adds total releases, format shares and the singles-to-albums ratio."""
    albums, singles = F.col("total_albums"), F.col("total_singles")
    total = albums + singles
    return df.withColumns({
        "total_releases": total,
        "single_pct": metrics.pct(singles, total, digits),
        "album_pct": metrics.pct(albums, total, digits),
        "single_to_album_ratio": metrics.ratio(singles, albums),
    })


def _activity(joined: DataFrame) -> DataFrame:
    return release_mix(joined).withColumns({
        "catalog_strategy": metrics.strategy_by_ratio(F.col("single_to_album_ratio")),
        "activity_tier": metrics.activity_tier(F.col("recent_releases_12m")),
    })


def strategy_mix(fact: DataFrame) -> DataFrame:
    """Fact with shares, strategy and tier, without names or ranks."""
    return _activity(fact)


def mart_artist_activity(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    ranked = rank_per_snapshot(
        _activity(with_artist(fact, dim_artist)), ["recent_releases_12m", "total_releases"], "activity_rank"
    )
    return ranked.select(*ACTIVITY_COLUMNS)


def mart_artist_activity_latest(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    latest = with_artist(latest_snapshot_filter(fact), dim_artist)
    ranked = rank_global(_activity(latest), ["recent_releases_12m", "total_releases"], "activity_rank")
    return ranked.select(*ACTIVITY_COLUMNS)


def mart_catalog_growth(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    lagged = prev_value_lag(with_artist(fact, dim_artist), "total_tracks", "prev_tracks")
    current, previous = F.col("total_tracks"), F.col("prev_tracks")
    classed = lagged.withColumns({
        "current_tracks": current,
        "net_tracks_added": F.coalesce(current - previous, F.lit(0)),
        "growth_classification": metrics.growth_class_by_count(current, previous),
    })
    return rank_per_snapshot(classed, ["net_tracks_added", "current_tracks"], "expansion_rank").select(*GROWTH_COLUMNS)


def mart_release_seasonality(dim_album: DataFrame) -> DataFrame:
    """At most one row per month value; the rank runs over those rows."""
    monthly = A.format_counts_by_month(dim_album)
    ranked = rank_global(monthly, ["total_releases"], "volume_rank")
    return ranked.withColumns({
        "month_name": metrics.month_name(F.col("release_month")),
        "industry_season_archetype": metrics.season_archetype(F.col("release_month")),
    }).select(*SEASON_COLUMNS)


def _momentum(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    lagged = prev_value_lag(with_artist(fact, dim_artist), "catalog_momentum_index", "prev_momentum")
    index, previous = F.col("catalog_momentum_index"), F.col("prev_momentum")
    pillars = metrics.momentum_pillars(
        F.col("recent_releases_12m"), F.col("catalog_growth_pct"), F.col("median_release_cadence_days")
    )
    return lagged.withColumns({
        "momentum_tier": metrics.momentum_tier(index),
        **pillars,
        "momentum_delta": metrics.momentum_delta(index, previous),
        "trajectory_direction": metrics.trajectory(index, previous),
    })


def mart_artist_momentum(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    ranked = rank_per_snapshot(_momentum(fact, dim_artist), ["catalog_momentum_index"], "momentum_rank")
    return ranked.select(*MOMENTUM_COLUMNS)


def mart_artist_momentum_latest(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Latest snapshot only; the predecessor is looked up before the filter."""
    latest = latest_snapshot_filter(_momentum(fact, dim_artist), fact)
    return rank_global(latest, ["catalog_momentum_index"], "momentum_rank").select(*MOMENTUM_LATEST_COLUMNS)


def register_mart_views(spark: SparkSession) -> tuple[str, ...]:
    """The four marts as temporary views over the registered Gold views."""
    fact, artist, album = (spark.table(n) for n in ("fact_artist_snapshot", "dim_artist", "dim_album"))
    views = {
        "mart_artist_activity": mart_artist_activity(fact, artist),
        "mart_catalog_growth": mart_catalog_growth(fact, artist),
        "mart_release_seasonality": mart_release_seasonality(album),
        "mart_artist_momentum": mart_artist_momentum(fact, artist),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return tuple(views)
