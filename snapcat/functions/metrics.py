"""Business metrics as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapcat import model as M


def surrogate_key(natural: Column) -> Column:
    """Hex MD5 of the natural key: stable across runs, needs no lookup."""
    return F.md5(natural)


def surrogate_key_text(column: str) -> str:
    """The same as SQL text over a column."""
    return f"md5({column})"


def date_key(day: Column) -> Column:
    """DATE -> integer yyyymmdd."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def pct(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """``part`` as a percentage of ``whole`` in doubles; NULL when whole is 0."""
    value = part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def growth_pct(current: Column, previous: Column) -> Column:
    """Relative change in percent; NULL (never 0) without a usable predecessor."""
    change = (current - previous).cast("double") / F.nullif(previous.cast("double"), F.lit(0.0))
    return F.round(change * 100.0, 2)


def score_recent(recent: Column) -> Column:
    return F.least(F.lit(100.0), recent.cast("double") * M.POINTS_PER_RELEASE)


def score_growth(growth: Column) -> Column:
    scored = clamp(F.lit(M.GROWTH_NEUTRAL) + growth * M.GROWTH_SLOPE, 0.0, 100.0)
    return F.when(growth.isNull(), F.lit(M.GROWTH_NEUTRAL)).otherwise(scored)


def score_cadence(days: Column) -> Column:
    window = M.CADENCE_WORST_DAYS - M.CADENCE_BEST_DAYS
    drop = (days - M.CADENCE_BEST_DAYS) / window * M.CADENCE_SPAN
    scored = clamp(F.lit(100.0) - drop, M.CADENCE_FLOOR, 100.0)
    return F.when(days.isNull(), F.lit(M.CADENCE_NEUTRAL)).otherwise(scored)


def momentum_raw(recent: Column, growth: Column, cadence: Column) -> Column:
    """Weighted sum of the three scores, before clamping and rounding."""
    return (
        score_recent(recent) * M.WEIGHT_RECENT
        + score_growth(growth) * M.WEIGHT_GROWTH
        + score_cadence(cadence) * M.WEIGHT_CADENCE
    )


def momentum_index(recent: Column, growth: Column, cadence: Column) -> Column:
    return F.round(clamp(momentum_raw(recent, growth, cadence), 0.0, 100.0), 2)


def momentum_pillars(recent: Column, growth: Column, cadence: Column) -> dict[str, Column]:
    """The three weighted contributions, each rounded for display."""
    return {
        "volume_score": F.round(score_recent(recent) * M.WEIGHT_RECENT, 1),
        "growth_score": F.round(score_growth(growth) * M.WEIGHT_GROWTH, 1),
        "cadence_score": F.round(score_cadence(cadence) * M.WEIGHT_CADENCE, 1),
    }


def banded(value: Column, bands: Sequence[tuple]) -> Column:
    """First label whose lower bound ``value`` reaches; NULL falls to the last."""
    *bounded, (_, otherwise) = bands
    (bound, label), *rest = bounded
    expr = F.when(value >= bound, F.lit(label))
    for bound, label in rest:
        expr = expr.when(value >= bound, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def momentum_tier(index: Column) -> Column:
    return banded(index, M.MOMENTUM_TIERS)


def activity_tier(recent: Column) -> Column:
    return banded(recent, M.ACTIVITY_TIERS)


def strategy_by_ratio(single_to_album: Column) -> Column:
    """Strategy from singles per album; no albums at all counts as album-focused."""
    return banded(single_to_album, M.STRATEGY_BY_RATIO)


def strategy_by_share(single_pct: Column) -> Column:
    """Strategy from the singles' share of all releases (other cut-offs and label)."""
    return banded(single_pct, M.STRATEGY_BY_SHARE)


def growth_class_by_count(current: Column, previous: Column) -> Column:
    return (
        F.when(previous.isNull(), F.lit(M.GROWTH_BASELINE))
        .when(current > previous, F.lit(M.GROWTH_EXPANSION))
        .when(current == previous, F.lit(M.GROWTH_STATIC))
        .otherwise(F.lit(M.GROWTH_REDUCTION))
    )


def growth_class_by_pct(growth: Column) -> Column:
    return (
        F.when(growth.isNull(), F.lit(M.GROWTH_BASELINE))
        .when(growth > 0, F.lit(M.GROWTH_EXPANSION))
        .when(growth == 0, F.lit(M.GROWTH_STATIC))
        .otherwise(F.lit(M.GROWTH_PRUNING))
    )


def trajectory(current: Column, previous: Column) -> Column:
    return (
        F.when(previous.isNull(), F.lit(M.TRAJECTORY_INITIAL))
        .when(current > previous, F.lit(M.TRAJECTORY_UP))
        .when(current < previous, F.lit(M.TRAJECTORY_DOWN))
        .otherwise(F.lit(M.TRAJECTORY_FLAT))
    )


def momentum_delta(current: Column, previous: Column) -> Column:
    return F.round(current - previous, 2)


def season_archetype(month: Column) -> Column:
    *named, (_, otherwise) = M.SEASON_ARCHETYPES
    (months, label), *rest = named
    expr = F.when(month.isin(*months), F.lit(label))
    for months, label in rest:
        expr = expr.when(month.isin(*months), F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def month_name(month: Column) -> Column:
    """Full English month name; NULL for numbers outside 1..12."""
    first_day = F.concat(F.lit("2024-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-01"))
    return F.date_format(F.try_to_date(first_day, "yyyy-MM-dd"), "MMMM")


def iso_weekday(day: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(day) + 1
