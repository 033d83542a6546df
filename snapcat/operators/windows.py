"""Window operators whose groups are bounded by the calendar or by the snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapcat.model import SNAPSHOT
from snapcat.functions import metrics
from snapcat.operators.aggregates import ALBUM_MEASURES, GRID, released


def release_gaps(albums: DataFrame) -> DataFrame:
    """Days between consecutive distinct release days per artist and snapshot.

    ``distinct`` runs first and shuffles by (artist, snapshot, day), so the
    window only ever sees distinct days of one artist.
    """
    days = albums.filter(released()).select(*GRID, "release_date").distinct()
    return gaps_of_days(days)


def gaps_of_days(days: DataFrame) -> DataFrame:
    """Gaps from one row per (artist, snapshot, release day)."""
    window = Window.partitionBy(*GRID).orderBy("release_date")
    gap = F.datediff(F.col("release_date"), F.lag("release_date").over(window))
    return days.select(*GRID, "release_date", gap.alias("gap_days")).filter(F.col("gap_days").isNotNull())


def _ranked_gaps(gaps: DataFrame) -> DataFrame:
    group = Window.partitionBy(*GRID)
    return gaps.select(
        *GRID,
        "gap_days",
        F.row_number().over(group.orderBy("gap_days")).alias("position"),
        F.count(F.lit(1)).over(group).alias("size"),
    )


def median_cadence(gaps: DataFrame) -> DataFrame:
    """Lower median of the gaps, exact: of an even number the smaller middle one.

    Selecting the middle row reuses the partitioning of the gaps, so the median
    adds a sort but neither a shuffle nor per-group digests.
    """
    middle = F.floor((F.col("size") + 1) / 2)
    return _ranked_gaps(gaps).filter(F.col("position") == middle).select(
        *GRID, F.col("gap_days").cast("double").alias("median_release_cadence_days")
    )


def exact_median_cadence(gaps: DataFrame) -> DataFrame:
    """Averaging median of the gaps."""
    low, high = F.floor((F.col("size") + 1) / 2), F.floor(F.col("size") / 2) + 1
    return (
        _ranked_gaps(gaps)
        .filter(F.col("position").isin(low, high))
        .groupBy(*GRID)
        .agg(F.avg(F.col("gap_days").cast("double")).alias("median_cadence_days"))
    )


def release_summary(days: DataFrame) -> DataFrame:
    """Release counts and cadence per artist and snapshot from release days.

    Gap, rank of the gap and totals are windows over the same partitioning, and
    the row in the middle carries the result.  So the albums are read once and
    their days are shuffled once; a group is bounded by the calendar.
    """
    group = Window.partitionBy(*GRID)
    gap = F.datediff(F.col("release_date"), F.lag("release_date").over(group.orderBy("release_date")))
    ranked = days.withColumn("gap_days", gap).select(
        *GRID,
        F.col("gap_days").cast("double").alias("median_release_cadence_days"),
        F.row_number().over(group.orderBy(F.col("gap_days").asc_nulls_last())).alias("position"),
        F.count("gap_days").over(group).alias("gaps"),
        *(F.sum(measure).over(group).alias(measure) for measure in ALBUM_MEASURES),
    )
    middle = F.greatest(F.floor((F.col("gaps") + 1) / 2), F.lit(1))
    return ranked.filter(F.col("position") == middle).drop("position", "gaps")


def prev_value_lag(df: DataFrame, value: str, name: str, key: str = "artist_key") -> DataFrame:
    """Value at the previous *available* snapshot of the same key."""
    window = Window.partitionBy(key).orderBy(SNAPSHOT)
    return df.withColumn(name, F.lag(value).over(window))


def growth_pct(df: DataFrame, value: str = "total_tracks", key: str = "artist_id") -> DataFrame:
    """Adds ``catalog_growth_pct`` against the previous available snapshot."""
    lagged = prev_value_lag(df, value, "__previous", key)
    return lagged.withColumn(
        "catalog_growth_pct", metrics.growth_pct(F.col(value), F.col("__previous"))
    ).drop("__previous")


def cohort_growth(fact: DataFrame) -> DataFrame:
    """Growth of the whole cohort: totals first, then the rate.

    The window runs over one row per snapshot.
    """
    totals = fact.groupBy(SNAPSHOT).agg(F.sum("total_tracks").alias("cohort_tracks"))
    previous = F.lag("cohort_tracks").over(Window.orderBy(SNAPSHOT))
    return totals.select(SNAPSHOT, "cohort_tracks", previous.alias("prev_cohort_tracks")).withColumn(
        "cohort_growth_pct",
        metrics.pct(F.col("cohort_tracks") - F.col("prev_cohort_tracks"), F.col("prev_cohort_tracks")),
    )


def peak_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Top row of each group of an already aggregated table."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")
