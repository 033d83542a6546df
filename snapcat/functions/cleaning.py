"""Cleaning expressions.

ANSI mode turns a bad cast into an exception, so everything that reads foreign
text goes through ``try_*`` and yields NULL instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapcat.model import COUNT_SENTINELS, DATE_SENTINELS


def trimmed(name: str) -> Column:
    """Column ``name`` as text without outer blanks."""
    return F.trim(F.col(name).cast("string"))


def nullify_sentinels(text: Column, sentinels: Sequence[str] = DATE_SENTINELS) -> Column:
    """Trimmed text, with placeholder values turned into NULL."""
    value = F.trim(text.cast("string"))
    return F.when(~value.isin(*sentinels), value)


def clean_count(value: Column) -> Column:
    """Integer from text or number; placeholders and garbage become NULL."""
    return nullify_sentinels(value, COUNT_SENTINELS).try_cast("int")


def release_year(text: Column) -> Column:
    """Year read from the first four characters, so it survives an unreadable day."""
    return F.when(F.length(text) >= 4, F.substring(text, 1, 4).try_cast("int"))


def known_month(text: Column) -> Column:
    """Month that the text states in characters six and seven (whatever separates them), NULL for a year alone."""
    return F.when(F.length(text) >= 7, F.substring(text, 6, 2).try_cast("int"))


def release_month(text: Column, only_known: bool = False) -> Column:
    """Month read from the text; text too short for one counts as January by default.

    ``only_known=True`` keeps year-only releases out of month statistics.
    """
    return known_month(text) if only_known else F.when(F.length(text).between(4, 6), 1).otherwise(known_month(text))


def normalize_partial_date(text: Column) -> Column:
    """DATE from ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD``; NULL if unreadable.

    The cast itself reads all three and gives the first day of a year or month.
    """
    return F.when(F.length(text).isin(4, 7, 10), text.try_cast("date"))


def decade_label(year: Column) -> Column:
    """``1987`` -> ``1980s``."""
    return F.concat((year - F.pmod(year, F.lit(10))).cast("string"), F.lit("s"))


def whole_number(name: str, dtype: str) -> Column:
    """Number read through trimmed text, NULL if it does not parse."""
    return trimmed(name).try_cast(dtype)


def duration_minutes(ms: Column) -> Column:
    return F.round(ms.cast("double") / 60000.0, 2)


def duration_seconds(ms: Column) -> Column:
    return F.round(ms.cast("double") / 1000.0, 1)


def text_or_empty_array(name: str) -> Column:
    """Array of strings, never NULL."""
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def since_text_filter(text: Column, since: str) -> Column:
    """Keep rows with no date text or with text not before ``since``.

    The comparison is on the raw text, so a year-only release of the year of
    ``since`` sorts before it and is dropped.
    """
    return text.isNull() | (text == "") | (text >= F.lit(since))


def since_date_filter(text: Column, since: str) -> Column:
    """Like :func:`since_text_filter`, but on the normalised date."""
    value = normalize_partial_date(nullify_sentinels(text))
    return value.isNull() | (value >= F.to_date(F.lit(since)))
