"""Incremental snapshots: carry the prior snapshot forward and apply a delta.

A delta is small next to the catalog.  Where the prior wins, only its *keys* are
read, and they are first narrowed to the delta's keys by a semi-join whose small
side AQE can broadcast, so the prior snapshot itself is never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcat.model import ENTITIES, ENTITY_KEY, SNAPSHOT


def _stamp(df: DataFrame, snapshot: str) -> DataFrame:
    kind = df.schema[SNAPSHOT].dataType
    return df.withColumn(SNAPSHOT, F.lit(snapshot).cast(kind))


def incremental_merge(
    prior: DataFrame,
    delta: DataFrame,
    key: str,
    snapshot: str,
    delta_wins: bool = False,
) -> DataFrame:
    """Prior rows plus delta rows, stamped with the new snapshot.

    ``delta_wins=False`` keeps the prior row of a key present in both (releases,
    items); ``True`` replaces it (creators).  The delta must be unique by ``key``.
    """
    if delta_wins:
        kept = prior.join(delta.select(key), key, "left_anti")
        merged = kept.select(*prior.columns).unionByName(delta.select(*prior.columns))
    else:
        known = prior.select(key).join(delta.select(key), key, "left_semi")
        new = delta.join(known, key, "left_anti")
        merged = prior.unionByName(new.select(*prior.columns))
    return _stamp(merged, snapshot)


def merge_snapshot(
    prior: Mapping[str, DataFrame], delta: Mapping[str, DataFrame], snapshot: str
) -> dict[str, DataFrame]:
    """One consistent new snapshot of the three tables.

    Creators that the delta leaves untouched are carried forward, others take their new row; releases and
    items of the prior snapshot stay, new ones are added.
    """
    return {
        entity: incremental_merge(prior[entity], delta[entity], ENTITY_KEY[entity], snapshot, delta_wins=entity == "artists")
        for entity in ENTITIES
    }


def split_known_releases(delta_albums: DataFrame, history_tracks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(releases whose items are already in history, releases still to fetch)."""
    seen = history_tracks.select("album_id").join(delta_albums.select("album_id"), "album_id", "left_semi")
    return (
        delta_albums.join(seen, "album_id", "left_semi"),
        delta_albums.join(seen, "album_id", "left_anti"),
    )


def track_cache_reuse(history_tracks: DataFrame, delta_albums: DataFrame, snapshot: str) -> DataFrame:
    """Historic items of the delta's releases, restamped; nothing is fetched for them."""
    reused = history_tracks.join(delta_albums.select("album_id"), "album_id", "left_semi")
    return _stamp(reused.select(*history_tracks.columns), snapshot)
