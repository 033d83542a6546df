"""Snapshots as intervals: a merge writes what changed, reading expands it again.

The log of a table holds a row for each version of a key, with the snapshot from which it is valid, and a row
without content where a key went.  Carrying a snapshot forward costs nothing; a merge appends a partition as large as
its delta.  :func:`intervals` closes each version at the next one of its key, :func:`as_of` gives the rows
of any snapshot as if the table had been copied then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapcat.model import SNAPSHOT

VALID_TO, GONE = "valid_to", "gone"


def _day(snapshot: str) -> Column:
    return F.to_date(F.lit(snapshot))


def opened(df: DataFrame, snapshot: str) -> DataFrame:
    """Log rows for ``df`` (one per key), valid from ``snapshot``; its own snapshot is replaced."""
    return df.withColumn(SNAPSHOT, _day(snapshot)).withColumn(GONE, F.lit(False))


def changes(log: DataFrame, delta: DataFrame, key: str, snapshot: str, delta_wins: bool = False, removed: DataFrame | None = None) -> DataFrame:
    """What a merge of ``delta`` at ``snapshot`` adds to the log.

    ``delta_wins=False`` keeps the row of a key that is there (releases, items) and adds new keys only; ``True``
    replaces rows whose content differs (creators).  ``removed`` names keys that end with this snapshot.  Entries of this snapshot and later are ignored, so a rerun
    of a merge gives the same rows again, to overwrite its partition.
    """
    content = [c for c in log.columns if c not in (SNAPSHOT, GONE)]
    earlier = log.filter(F.col(SNAPSHOT) < _day(snapshot))
    if not delta_wins:
        # Only the delta's keys of the log are looked at.
        touched = earlier.select(key, SNAPSHOT, GONE).join(delta.select(key), key, "left_semi")
        there = touched.groupBy(key).agg(F.max_by(GONE, SNAPSHOT).alias(GONE)).filter(~F.col(GONE)).select(key)
        new = delta.join(there, key, "left_anti")
    else:
        touched = earlier.join(delta.select(key), key, "left_semi")
        current = touched.groupBy(key).agg(F.max_by(F.struct(GONE, *content), SNAPSHOT).alias("now")).filter("NOT now.gone").select(
            F.col(key).alias("__key"), F.xxhash64(*(F.col(f"now.{c}") for c in content)).alias("__print"))
        same = (F.col(key) == F.col("__key")) & (F.xxhash64(*content) == F.col("__print"))
        new = delta.join(current, same, "left_anti")
    out = opened(new.select(*content, SNAPSHOT), snapshot).select(*log.columns)
    if removed is not None:
        kinds = dict(earlier.dtypes)
        ended = removed.select(key).distinct().join(delta.select(key), key, "left_anti").select(
            *(F.col(c) if c == key else F.lit(None).cast(kinds[c]).alias(c) for c in content)).withColumn(SNAPSHOT, _day(snapshot)).withColumn(GONE, F.lit(True))
        out = out.unionByName(ended.select(*log.columns))
    return out


def intervals(log: DataFrame, key: str) -> DataFrame:
    """Versions with ``snapshot_date`` (first snapshot) and ``valid_to`` (the first that no longer has it, NULL if none)."""
    following = F.lead(SNAPSHOT).over(Window.partitionBy(key).orderBy(SNAPSHOT))
    return log.withColumn(VALID_TO, following).filter(~F.col(GONE)).drop(GONE)


def as_of(log: DataFrame, key: str, snapshot: str) -> DataFrame:
    """Rows of the table at ``snapshot``, stamped with it.

    Later partitions of the log are not read, so a version that they close is still open.
    """
    known = intervals(log.filter(F.col(SNAPSHOT) <= _day(snapshot)), key)
    return known.filter(F.col(VALID_TO).isNull()).drop(VALID_TO).withColumn(SNAPSHOT, _day(snapshot)).select(*(c for c in log.columns if c != GONE))


def expanded(log: DataFrame, key: str, snapshots: Sequence[str]) -> DataFrame:
    """The copied table for ``snapshots``: every version once per snapshot of its interval, in one pass."""
    days = F.array(*(_day(s) for s in snapshots))
    inside = lambda d: (d >= F.col(SNAPSHOT)) & (F.col(VALID_TO).isNull() | (d < F.col(VALID_TO)))
    seen = intervals(log, key).withColumn("__day", F.explode(F.filter(days, inside)))
    return seen.withColumn(SNAPSHOT, F.col("__day")).select(*(c for c in log.columns if c != GONE))
