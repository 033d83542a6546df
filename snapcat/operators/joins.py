"""Equi-join operators.

No broadcast hints: dimension and parent tables grow with the data, so the
choice is left to AQE, which sees their real size.  A hot key on the big side is
split by AQE's skew join; operators that only need counts pre-aggregate by key
before the join, so the big side never moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapcat.model import SNAPSHOT
from snapcat.operators.dedupe import marked
from snapcat.session import scratch_path

GRID = ("artist_id", SNAPSHOT)


def snapshot_grid_join(
    grid: DataFrame,
    measures: Sequence[DataFrame],
    keys: Sequence[str] = GRID,
    zero_filled: Sequence[str] = (),
) -> DataFrame:
    """Left-join measure tables onto the distinct key grid; fill counts only."""
    out = grid.select(*keys).distinct()
    for measure in measures:
        out = out.join(measure, list(keys), "left")
    return out.fillna(0, subset=list(zero_filled)) if zero_filled else out


def fact_dim_join(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fact rows with attributes of a dimension (inner)."""
    return fact.join(dim.select(key, *columns), key)


def _parent_keys(parent: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    # Semi and anti joins ignore duplicates on the right, so no distinct here.
    return parent.select(*(F.col(pk).alias(f"__parent_{i}") for i, (_, pk) in enumerate(keys)))


def _on(keys: Sequence[tuple[str, str]]):
    condition = F.lit(True)
    for i, (fk, _) in enumerate(keys):
        match = F.col(fk) == F.col(f"__parent_{i}")
        condition = match if i == 0 else condition & match
    return condition


def _pairs(foreign_key: str, parent_key: str | None, within: Sequence[str]) -> list[tuple[str, str]]:
    return [(foreign_key, parent_key or foreign_key), *((name, name) for name in within)]


def orphans_anti(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: str,
    parent_key: str | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Child rows without a parent; a NULL foreign key is an orphan.

    ``within`` adds columns that must match too, such as the snapshot.
    """
    keys = _pairs(foreign_key, parent_key, within)
    return child.join(_parent_keys(parent, keys), _on(keys), "left_anti")


def orphans_by_keys(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: str,
    parent_key: str | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """:func:`orphans_anti` where orphans are few: only the distinct foreign keys and rows that a filter of the lacking ones hits are shuffled."""
    keys = _pairs(foreign_key, parent_key, within)
    names = [fk for fk, _ in keys]
    parents = _parent_keys(parent, keys).distinct()
    lacking = child.select(*names).distinct().join(parents, _on(keys), "left_anti")
    hits = marked(child, lacking, F.xxhash64(*names)).filter("__hit").select(*child.columns)
    # An anti join would be moved below the filter, to all rows.
    found = hits.join(parents.withColumn("__found", F.lit(1)), _on(keys), "left")
    return found.filter(F.col("__found").isNull()).select(*child.columns)


def split_by_keys(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: str,
    parent_key: str | None = None,
    within: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(:func:`keep_with_parent_semi`, :func:`orphans_anti`) where orphans are few.

    The keys that lack a parent are found from the distinct ones and staged; rows that a filter of them does not hit have a
    parent and stay where they are, the others meet the lacking keys themselves.
    """
    spark, keys = child.sparkSession, _pairs(foreign_key, parent_key, within)
    names = [fk for fk, _ in keys]
    path = scratch_path(spark, "lacking")
    lacking = child.select(*names).distinct().join(_parent_keys(parent, keys), _on(keys), "left_anti")
    lacking.write.parquet(path)
    lacking = spark.read.schema(lacking.schema).parquet(path)
    rows = marked(child, lacking, F.xxhash64(*names))
    none = lacking.select(*(F.col(name).alias(f"__lacking_{i}") for i, name in enumerate(names)), F.lit(True).alias("__lacks"))
    same = reduce(Column.__and__, (F.col(name).eqNullSafe(F.col(f"__lacking_{i}")) for i, name in enumerate(names)))
    hits = rows.filter("__hit").select(*child.columns).join(none, same, "left")
    kept = rows.filter(~F.col("__hit")).select(*child.columns).unionByName(hits.filter(F.col("__lacks").isNull()).select(*child.columns))
    return kept, hits.filter(F.col("__lacks").isNotNull()).select(*child.columns)


def keep_with_parent_semi(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: str,
    parent_key: str | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Child rows that have a parent."""
    keys = _pairs(foreign_key, parent_key, within)
    return child.join(_parent_keys(parent, keys), _on(keys), "left_semi")


def orphan_counts(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: str,
    parent_key: str | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """(within..., total_rows, orphan_count) with only key counts shuffled.

    The child is reduced to one row per foreign key before it meets the parent,
    so neither a hot key nor a large share of NULL keys reaches one task.
    """
    keys = _pairs(foreign_key, parent_key, within)
    per_key = child.groupBy(foreign_key, *within).agg(F.count(F.lit(1)).alias("__rows"))
    parents = _parent_keys(parent, keys).distinct().withColumn("__found", F.lit(1))
    matched = per_key.join(parents, _on(keys), "left")
    return matched.groupBy(*within).agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("__found").isNull(), F.col("__rows"))), F.lit(0)).alias("orphan_count"),
    )


def orphan_audit_left_join(fact: DataFrame, dim: DataFrame, key: str, by: Sequence[str] = (SNAPSHOT,)) -> DataFrame:
    """Rows and orphan rows of a fact per group."""
    found = dim.select(key).distinct().withColumn("__found", F.lit(1))
    return fact.join(found, key, "left").groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        (F.count(F.lit(1)) - F.count("__found")).alias("orphan_count"),
    )


def album_with_artist(dim_album: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Albums with the name of *their* artist; one row per album."""
    return dim_album.join(dim_artist.select("artist_key", "artist_name"), "artist_key")


def track_album_artist_join(dim_track: DataFrame, dim_album: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Tracks with album and the album's artist.

    The two smaller tables meet first, so the tracks are shuffled once, on
    ``album_key``, instead of once per join.
    """
    albums = album_with_artist(
        dim_album.select("album_key", "artist_key", "album_name", "album_type", "release_date"), dim_artist
    ).drop("artist_key")
    tracks = dim_track.select(
        "album_key", "track_id", "track_name", "duration_ms", "explicit", "disc_number", "track_number"
    )
    return tracks.join(albums, "album_key")


def presence_matrix(
    artists: DataFrame,
    tracks: DataFrame,
    snapshots: Sequence[str],
) -> DataFrame:
    """One row per artist; per snapshot whether it was seen and its track count.

    ``snapshots`` is the report's column list, so the pivot needs no extra job.
    ``missing_in`` lists the snapshots after the first sighting without the artist.
    """
    seen = artists.groupBy("artist_id", SNAPSHOT).agg(F.max("artist_name").alias("artist_name"))
    counts = tracks.groupBy("artist_id", SNAPSHOT).agg(F.count("track_id").alias("track_count"))
    cells = seen.join(counts, list(GRID), "left").filter(F.col(SNAPSHOT).isin([_day(s) for s in snapshots]))

    out = cells.groupBy("artist_id").agg(
        F.max_by("artist_name", SNAPSHOT).alias("artist_name"),
        *(
            expr
            for s in snapshots
            for expr in (
                (F.count(F.when(F.col(SNAPSHOT) == _day(s), 1)) > 0).alias(f"present_{_suffix(s)}"),
                F.max(
                    F.when(F.col(SNAPSHOT) == _day(s), F.coalesce("track_count", F.lit(0)))
                ).alias(f"tracks_{_suffix(s)}"),
            )
        ),
    )
    ordered = sorted(snapshots)
    gaps = []
    for i, s in enumerate(ordered):
        earlier = F.lit(False)
        for before in ordered[:i]:
            earlier = earlier | F.col(f"present_{_suffix(before)}")
        gaps.append(F.when(earlier & ~F.col(f"present_{_suffix(s)}"), F.lit(s)))
    return out.withColumn("missing_in", F.concat_ws(",", *gaps))


def presence_bits(artists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(artist_id, word, bits) and (snapshot_date, ordinal): which snapshots saw an artist, 64 to a word.

    Snapshots are numbered by date as they are found; there may be any number.  A task sends at most one long for an
    artist and word, so the sightings themselves are not shuffled.
    """
    days = artists.filter(F.col(SNAPSHOT).isNotNull()).select(SNAPSHOT).distinct()
    # The calendar bounds the list of snapshots.
    ordinals = days.withColumn("ordinal", F.row_number().over(Window.orderBy(SNAPSHOT)) - 1)
    numbered = artists.select("artist_id", SNAPSHOT).join(F.broadcast(ordinals), SNAPSHOT)
    bits = numbered.groupBy("artist_id", F.shiftright("ordinal", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, ordinal & 63))").alias("bits"))
    return bits, ordinals


def presence_gaps(artists: DataFrame) -> DataFrame:
    """Per artist: first and last sighting, number of sightings, and the snapshots since the first that lack it."""
    bits, ordinals = presence_bits(artists)
    # One array of days for all; it meets each artist's words by a one-row join.
    calendar = ordinals.agg(F.sort_array(F.collect_list(SNAPSHOT)).alias("days"))
    words = bits.groupBy("artist_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"))

    def seen(i: Column) -> Column:
        word = F.coalesce(F.try_element_at("words", F.shiftright(i, 6)), F.lit(0).cast("long"))
        return F.call_function("shiftright", word, i.bitwiseAND(63)).bitwiseAND(1) == 1

    places = F.sequence(F.lit(0), F.size("days") - 1)
    out = words.withColumn("days", calendar.scalar()).withColumns({
        "here": F.filter(places, seen), "away": F.filter(places, lambda i: ~seen(i))})
    day_of = lambda i: F.get("days", i)
    return out.select(
        "artist_id", day_of(F.get("here", 0)).alias("first_seen"), day_of(F.element_at("here", -1)).alias("last_seen"),
        F.size("here").cast("long").alias("times_seen"),
        F.array_join(F.transform(F.filter("away", lambda i: i > F.get("here", 0)), lambda i: day_of(i).cast("string")), ",").alias("missing_in"))


def missing_later(artists: DataFrame, earlier: str, later: str) -> DataFrame:
    """Artists seen at ``earlier`` and absent at ``later``."""
    before = artists.filter(F.col(SNAPSHOT) == _day(earlier))
    after = artists.filter(F.col(SNAPSHOT) == _day(later))
    return orphans_anti(before, after, "artist_id").select("artist_id", "artist_name")


def _day(text: str):
    return F.to_date(F.lit(text))


def _suffix(text: str) -> str:
    return text.replace("-", "")
