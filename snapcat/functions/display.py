"""Text for presentation.  All of it stays in the JVM.

``format_number`` rounds half-even on the exact binary value, which is what
fixed-point text formatting does elsewhere too, so ``1250 / 1000`` is ``1.2``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapcat import model as M
from snapcat.functions.metrics import banded


def _fixed(value: Column, digits: int) -> Column:
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def grouped_number(value: Column) -> Column:
    """Thousands separators; one decimal only if there is a fraction."""
    number = value.cast("double")
    text = F.when(number == F.floor(number), F.format_number(number, 0)).otherwise(F.format_number(number, 1))
    return F.coalesce(text, F.lit(M.MISSING_TEXT))


def compact_number(value: Column) -> Column:
    """``1200`` -> ``1.2K``, ``3400000`` -> ``3.4M``."""
    number = value.cast("double")
    text = (
        F.when(F.abs(number) >= 1_000_000, F.concat(_fixed(number / 1_000_000, 1), F.lit("M")))
        .when(F.abs(number) >= 1_000, F.concat(_fixed(number / 1_000, 1), F.lit("K")))
        .when(number == F.floor(number), _fixed(number, 0))
        .otherwise(_fixed(number, 1))
    )
    return F.coalesce(text, F.lit(M.MISSING_TEXT))


def clock_duration(ms: Column) -> Column:
    """Milliseconds -> ``MM:SS``; missing or non-positive -> ``00:00``."""
    seconds = F.floor(ms / 1000)

    def two_digits(number: Column) -> Column:
        # Longer minute counts keep all their digits (lpad alone would cut them).
        text = number.cast("string")
        return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)

    text = F.concat(two_digits(F.floor(seconds / 60)), F.lit(":"), two_digits(seconds % 60))
    return F.when(ms > 0, text).otherwise(F.lit("00:00"))


def percentage_text(value: Column, is_ratio: bool = False, decimals: int = 1) -> Column:
    number = value.cast("double")
    number = number * 100.0 if is_ratio else number
    return F.coalesce(F.concat(_fixed(number, decimals), F.lit("%")), F.lit(M.MISSING_TEXT))


def momentum_badge(score: Column) -> Column:
    """Badge with its own cut-offs (75/50/25), not the tier ones."""
    return F.when(score.isNull(), F.lit(M.MOMENTUM_BADGE_NULL)).otherwise(banded(score, M.MOMENTUM_BADGES))


def _marked(label: Column, marks: list[tuple[tuple[str, ...], str]], otherwise: str, missing: str) -> Column:
    text = F.lower(label)
    expr = F.when(label.isNull() | (label == ""), F.lit(missing))
    for words, mark in marks:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        expr = expr.when(hit, F.concat(F.lit(f"{mark} "), label))
    return expr.otherwise(F.concat(F.lit(f"{otherwise} "), label))


def activity_badge(tier: Column) -> Column:
    return _marked(tier, *M.ACTIVITY_BADGES)


def strategy_badge(strategy: Column) -> Column:
    return _marked(strategy, *M.STRATEGY_BADGES)


def link(base: str, identifier: Column) -> Column:
    """Public page of an item: ``base`` followed by its natural id."""
    return F.concat(F.lit(base), identifier)
