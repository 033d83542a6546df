"""The eight standing questions.

NULL order is written out everywhere: engines disagree on the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcat.functions import metrics
from snapcat.model import SNAPSHOT
from snapcat.operators import aggregates as A
from snapcat.operators.ranking import rank_global
from snapcat.operators.windows import peak_per_group, prev_value_lag
from snapcat.plans.marts import release_mix, with_artist
from snapcat.sources.tables import latest_snapshot_filter


def _desc(*names: str):
    return [F.col(name).desc_nulls_last() for name in names]


def _latest(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    return with_artist(latest_snapshot_filter(fact), dim_artist)


def q1_top_active(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Most releases in the last 12 months."""
    ranked = rank_global(_latest(fact, dim_artist), ["recent_releases_12m"], "activity_rank")
    return ranked.select(
        "artist_name", "recent_releases_12m", "total_albums", "total_singles", "total_tracks",
        "catalog_momentum_index", "activity_rank",
    ).orderBy(*_desc("recent_releases_12m", "total_tracks"))


def q2_format_mix(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Format shares and the share-based strategy (unrounded share decides)."""
    share = metrics.pct(F.col("total_singles"), F.col("total_albums") + F.col("total_singles"), None)
    return release_mix(_latest(fact, dim_artist), digits=2).select(
        "artist_name", "total_albums", "total_singles", F.col("total_releases").alias("total_catalog_releases"),
        "single_pct", "album_pct", "single_to_album_ratio",
        metrics.strategy_by_share(share).alias("catalog_strategy"),
    ).orderBy(*_desc("single_to_album_ratio"))


def q3_growth_velocity(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Relative growth at every snapshot."""
    lagged = prev_value_lag(with_artist(fact, dim_artist), "total_tracks", "prev_tracks")
    return lagged.select(
        "artist_name", SNAPSHOT, "total_tracks", "prev_tracks", "catalog_growth_pct",
        metrics.growth_class_by_pct(F.col("catalog_growth_pct")).alias("growth_classification"),
    ).orderBy(
        F.col(SNAPSHOT).desc_nulls_last(),
        F.coalesce("catalog_growth_pct", F.lit(-1.0)).desc(),
        F.col("total_tracks").desc_nulls_last(),
    )


def q4_net_tracks_added(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Absolute growth at the latest snapshot."""
    lagged = prev_value_lag(with_artist(fact, dim_artist), "total_tracks", "prev_tracks")
    latest = latest_snapshot_filter(lagged, fact).select(
        "artist_name", SNAPSHOT, "prev_tracks", F.col("total_tracks").alias("current_tracks"),
        F.coalesce(F.col("total_tracks") - F.col("prev_tracks"), F.lit(0)).alias("net_tracks_added"),
        "catalog_growth_pct",
    )
    ranked = rank_global(latest, ["net_tracks_added", "current_tracks"], "expansion_rank")
    return ranked.orderBy(*_desc("net_tracks_added", "current_tracks"))


def q5_monthly_distribution(dim_album: DataFrame) -> DataFrame:
    """Releases per month and format."""
    ranked = rank_global(A.format_counts_by_month(dim_album), ["total_releases"], "popularity_rank")
    return ranked.select(
        "release_month", metrics.month_name(F.col("release_month")).alias("month_name"), "total_releases",
        "studio_albums", "singles", "compilations", "single_share_pct", "popularity_rank",
    ).orderBy("release_month")


def q6_peak_month(dim_album: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Each artist's strongest month and its share of all releases.

    The lifetime total includes releases whose month is unknown; the peak does not.
    """
    monthly = A.agg_self_join(
        A.releases_by_artist_month(dim_album, dim_artist), "artist_name", "releases_in_month",
        "lifetime_releases", "peak_month_concentration_pct",
    )
    peak = peak_per_group(
        monthly.filter(F.col("release_month").isNotNull()),
        ["artist_name"],
        [F.col("releases_in_month").desc(), F.col("release_month").asc()],
    )
    return peak.select(
        "artist_name",
        metrics.month_name(F.col("release_month")).alias("peak_release_month"),
        F.col("releases_in_month").alias("peak_month_drops"),
        F.col("lifetime_releases").alias("total_catalog_releases"),
        "peak_month_concentration_pct",
    ).orderBy(*_desc("total_catalog_releases"))


def q7_momentum_leaderboard(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Rank and tier by momentum index."""
    ranked = rank_global(_latest(fact, dim_artist), ["catalog_momentum_index"], "momentum_rank")
    return ranked.select(
        "momentum_rank", "artist_name", "catalog_momentum_index", "total_tracks", "recent_releases_12m",
        "median_release_cadence_days", "catalog_growth_pct",
        metrics.momentum_tier(F.col("catalog_momentum_index")).alias("momentum_tier"),
    ).orderBy("momentum_rank")


def q8_momentum_delta(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Change of the index since the previous snapshot."""
    lagged = prev_value_lag(with_artist(fact, dim_artist), "catalog_momentum_index", "prev_momentum")
    index, previous = F.col("catalog_momentum_index"), F.col("prev_momentum")
    return latest_snapshot_filter(lagged, fact).select(
        "artist_name", SNAPSHOT, "prev_momentum", index.alias("current_momentum"),
        metrics.momentum_delta(index, previous).alias("momentum_delta"),
        metrics.trajectory(index, previous).alias("trajectory_direction"),
    ).orderBy(
        F.coalesce(F.col("current_momentum") - F.col("prev_momentum"), F.lit(0.0)).desc(),
        F.col("current_momentum").desc_nulls_last(),
    )
