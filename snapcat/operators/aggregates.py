"""Aggregations over catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapcat.functions import metrics
from snapcat.model import RECENT_WINDOW_DAYS, SNAPSHOT

GRID = ("artist_id", SNAPSHOT)
ALBUM_MEASURES = ("total_albums", "total_singles", "recent_releases_12m")


def released(column: str = "release_date"):
    """Release known and not after the snapshot that reports it."""
    return F.col(column).isNotNull() & (F.col(column) <= F.col(SNAPSHOT))


def is_recent(days: int = RECENT_WINDOW_DAYS):
    """Album or single released within ``days`` before the snapshot, both ends included."""
    return F.col("album_type").isin("album", "single") & F.col("release_date").between(
        F.date_sub(F.col(SNAPSHOT), days), F.col(SNAPSHOT)
    )


def track_counts(tracks: DataFrame, keys_unique: bool = False) -> DataFrame:
    """Distinct tracks per artist and snapshot, released or not.

    With ``keys_unique`` (Silver: one row per track and snapshot) a plain count
    is the same number and combines on the map side, so no track id is shuffled.
    """
    counted = F.count("track_id") if keys_unique else F.countDistinct("track_id")
    return tracks.groupBy(*GRID).agg(counted.alias("total_tracks"))


def album_counts(albums: DataFrame, keys_unique: bool = False, days: int = RECENT_WINDOW_DAYS) -> DataFrame:
    """Released albums, singles and recent releases per artist and snapshot.

    An artist without a released album keeps its row, with zeros.  One flag per
    measure instead of three DISTINCT aggregates, which would triple the rows.  If
    ids may repeat, flags are first reduced per album id; that step spreads a hot
    artist over all tasks by album.
    """
    counts = F.col("album_id").isNotNull() & released()

    def flag(condition):
        return (counts & condition).cast("int")

    flagged = albums.select(
        *GRID,
        "album_id",
        flag(F.col("album_type") == "album").alias("total_albums"),
        flag(F.col("album_type") == "single").alias("total_singles"),
        flag(is_recent(days)).alias("recent_releases_12m"),
    )
    if not keys_unique:
        flagged = flagged.groupBy(*GRID, "album_id").agg(*(F.max(m).alias(m) for m in ALBUM_MEASURES))
    return flagged.groupBy(*GRID).agg(
        *(F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in ALBUM_MEASURES)
    )


def release_days(albums: DataFrame, days: int = RECENT_WINDOW_DAYS) -> DataFrame:
    """Release activity per artist, snapshot and release day (unique album ids).

    A group of this result is bounded by the calendar, however many releases an
    artist has, so later windows over it cannot blow up on a hot artist.
    """
    return albums.filter(released()).groupBy(*GRID, "release_date").agg(
        F.count(F.when(F.col("album_type") == "album", F.col("album_id"))).alias("total_albums"),
        F.count(F.when(F.col("album_type") == "single", F.col("album_id"))).alias("total_singles"),
        F.count(F.when(is_recent(days), F.col("album_id"))).alias("recent_releases_12m"),
    )


def explicit_ratio(dim_track: DataFrame, dim_album: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Explicit and clean shares per artist name; unknown flags are in neither.

    Tracks are counted per album before any join: only one row per album moves.
    """
    per_album = dim_track.groupBy("album_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("explicit"), 1)).alias("explicit_n"),
        F.count(F.when(~F.col("explicit"), 1)).alias("clean_n"),
    )
    per_artist = (
        per_album.join(dim_album.select("album_key", "artist_key"), "album_key")
        .groupBy("artist_key")
        .agg(*(F.sum(c).alias(c) for c in ("n", "explicit_n", "clean_n")))
    )
    named = per_artist.join(dim_artist.select("artist_key", "artist_name"), "artist_key")
    return named.groupBy("artist_name").agg(
        F.sum("n").alias("total_tracks"),
        F.sum("explicit_n").alias("explicit_tracks"),
        metrics.pct(F.sum("explicit_n"), F.sum("n"), 1).alias("explicit_pct"),
        metrics.pct(F.sum("clean_n"), F.sum("n"), 1).alias("clean_pct"),
    )


def format_counts_by_month(dim_album: DataFrame) -> DataFrame:
    """Releases per calendar month and format with shares."""

    def of_type(kind: str):
        return F.count(F.when(F.col("album_type") == kind, 1))

    total = F.count(F.lit(1))
    return dim_album.filter(F.col("release_month").isNotNull()).groupBy("release_month").agg(
        total.alias("total_releases"),
        of_type("album").alias("studio_albums"),
        of_type("single").alias("singles"),
        of_type("compilation").alias("compilations"),
        metrics.pct(of_type("single"), total, 1).alias("single_share_pct"),
        metrics.pct(of_type("album"), total, 1).alias("album_share_pct"),
    )


def format_evolution_by_year(dim_album: DataFrame, first: int, last: int) -> DataFrame:
    """Albums, singles and all releases per release year within bounds."""
    year = F.substring(F.col("release_date").cast("string"), 1, 4).try_cast("int")
    return (
        dim_album.filter(F.col("release_date").isNotNull())
        .select(year.alias("release_year"), "album_type")
        .filter(F.col("release_year").between(first, last))
        .groupBy("release_year")
        .agg(
            F.count(F.when(F.col("album_type") == "album", 1)).alias("studio_albums"),
            F.count(F.when(F.col("album_type") == "single", 1)).alias("singles"),
            F.count(F.lit(1)).alias("total_releases"),
        )
    )


def cohort_sanity(fact: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Per snapshot: rows, distinct artists and names, totals, mean index, orphans."""
    dim = dim_artist.select(F.col("artist_key").alias("dim_key"), "artist_name")
    joined = fact.join(dim, fact["artist_key"] == F.col("dim_key"), "left")
    return joined.groupBy(SNAPSHOT).agg(
        F.count(F.lit(1)).alias("total_fact_rows"),
        # A fact has one row per artist and snapshot.
        F.count("artist_key").alias("distinct_artists"),
        F.countDistinct("artist_name").alias("resolved_artist_names"),
        F.sum("total_tracks").alias("cohort_total_tracks"),
        F.sum("total_albums").alias("cohort_total_albums"),
        F.sum("total_singles").alias("cohort_total_singles"),
        F.round(F.avg("catalog_momentum_index"), 2).alias("cohort_avg_momentum"),
        (F.count(F.lit(1)) - F.count("dim_key")).alias("orphan_artist_count"),
    )


def fact_rollup_by_snapshot(fact: DataFrame) -> DataFrame:
    return fact.groupBy(SNAPSHOT).agg(
        F.count(F.lit(1)).alias("total_artists"),
        F.sum("total_albums").alias("total_albums"),
        F.sum("total_tracks").alias("total_tracks"),
        F.round(F.avg("catalog_momentum_index"), 2).alias("avg_momentum"),
    )


def executive_kpis(fact: DataFrame, snapshot: str) -> DataFrame:
    """One row of totals for a snapshot; zeros when it holds nothing."""

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return fact.filter(F.col(SNAPSHOT) == F.to_date(F.lit(snapshot))).agg(
        F.countDistinct("artist_key").alias("total_artists"),
        total("total_tracks"),
        total("total_albums"),
        total("total_singles"),
        total("recent_releases_12m"),
        F.coalesce(F.round(F.avg("catalog_momentum_index"), 1), F.lit(0.0)).alias("cohort_avg_momentum"),
    )


def duplicate_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def releases_by_artist_month(dim_album: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Releases per artist name and month, the unknown month included.

    Albums are counted per artist key before names come in, so a hot artist
    moves one row per month.
    """
    per_key = dim_album.groupBy("artist_key", "release_month").agg(F.count(F.lit(1)).alias("n"))
    named = per_key.join(dim_artist.select("artist_key", "artist_name"), "artist_key")
    return named.groupBy("artist_name", "release_month").agg(F.sum("n").alias("releases_in_month"))


def agg_self_join(parts: DataFrame, group: str, value: str, total: str, share: str) -> DataFrame:
    """Partial aggregates next to the total of their group, and their share of it.

    The self-join of two aggregates as a window sum: one shuffle, no second scan.
    A group must consist of few parts, like the months of one artist.
    """
    whole = F.sum(value).over(Window.partitionBy(group))
    return parts.withColumn(total, whole).withColumn(share, metrics.pct(F.col(value), F.col(total), 1))


def catalog_trends(albums: DataFrame, tracks: DataFrame) -> DataFrame:
    """Per (release year, format, snapshot): volume, mean duration, explicit share.

    ``single_to_album_ratio`` is per (year, snapshot), repeated on its rows.
    Tracks are reduced per album first, so the join is one row per album.
    """
    per_album = tracks.groupBy("album_id", SNAPSHOT).agg(
        F.count(F.lit(1)).alias("tracks"),
        F.sum("duration_ms").alias("ms"),
        F.count("duration_ms").alias("timed"),
        F.count(F.when(F.col("explicit"), 1)).alias("explicit"),
    )
    keyed = albums.filter(F.col("release_year").isNotNull()).select(
        "album_id", SNAPSHOT, "release_year", "album_type"
    )
    grouped = keyed.join(per_album, ["album_id", SNAPSHOT], "left").groupBy(
        "release_year", "album_type", SNAPSHOT
    ).agg(
        F.count(F.lit(1)).alias("total_releases"),
        F.coalesce(F.sum("tracks"), F.lit(0)).alias("total_tracks"),
        F.round(F.sum("ms").cast("double") / F.nullif(F.sum("timed"), F.lit(0)) / 60000.0, 2).alias(
            "avg_track_duration_min"
        ),
        metrics.ratio(F.sum("explicit"), F.sum("tracks"), 4).alias("explicit_track_ratio"),
    )
    ratios = grouped.groupBy("release_year", SNAPSHOT).agg(
        metrics.ratio(
            F.sum(F.when(F.col("album_type") == "single", F.col("total_releases")).otherwise(0)),
            F.sum(F.when(F.col("album_type") == "album", F.col("total_releases")).otherwise(0)),
        ).alias("single_to_album_ratio")
    )
    return grouped.join(ratios, ["release_year", SNAPSHOT])


def metric_distribution(profile: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, max, averaging median and mean per snapshot, one row per metric.

    The exact median keeps one counter per distinct value; the metrics are small
    counts, whole days or two-decimal scores, so that stays small at any row count.
    """
    wide = profile.groupBy(SNAPSHOT).agg(
        *(
            F.struct(
                F.lit(name).alias("metric"),
                F.min(name).cast("double").alias("min_value"),
                F.max(name).cast("double").alias("max_value"),
                F.median(name).alias("median_value"),
                F.round(F.avg(name), 2).alias("mean_value"),
            ).alias(name)
            for name in columns
        )
    )
    return wide.select(SNAPSHOT, F.inline(F.array(*columns)))


def duration_histogram(durations: DataFrame, bins: int = 40) -> DataFrame:
    """Equal-width bins over ``duration_min`` with the median and quartiles.

    Durations are first counted per value; two-decimal minutes below 20 give at
    most 2,001 of them, so bounds, quantiles and bins all come from that small
    table and the rows are scanned once.
    """
    values = durations.groupBy("duration_min").agg(F.count(F.lit(1)).alias("n"))
    q = F.percentile("duration_min", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    stats = values.agg(
        F.min("duration_min").alias("low"),
        F.max("duration_min").alias("high"),
        q.alias("q"),
    )
    return _binned(values, stats, bins)


def _binned(values: DataFrame, stats: DataFrame, bins: int) -> DataFrame:
    row = stats.select(
        F.struct(
            "low",
            ((F.col("high") - F.col("low")) / bins).alias("width"),
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
        ).alias("s")
    )
    # A one-row scalar subquery, not a join.
    with_stats = values.withColumn("s", row.scalar())
    index = F.when(F.col("s.width") == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("duration_min") - F.col("s.low")) / F.col("s.width")), F.lit(bins - 1))
    )
    return with_stats.groupBy(index.cast("int").alias("bin")).agg(
        F.sum("n").alias("track_count"),
        F.round(F.first("s.q1"), 4).alias("q1_min"),
        F.round(F.first("s.median"), 4).alias("median_min"),
        F.round(F.first("s.q3"), 4).alias("q3_min"),
    )
