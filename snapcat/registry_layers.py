"""Queries over published layers, kept-up dimensions, intervals, damaged or repeated landings, and bitmaps."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcat.model import ENTITIES, ENTITY_KEY, SNAPSHOT
from snapcat.operators import checks, intervals, joins, ranking
from snapcat.plans import bronze, dimensions, marts, publish, silver
from snapcat.session import scratch_path
from snapcat.sources import raw as R
from snapcat.sources import tables as T
from snapcat.sources.driver_tables import SNAPSHOTS
from snapcat.sources.layers import Layer
from snapcat.streaming.landing import BATCH, incremental_landing
from snapcat.warehouse import Warehouse

FIRST, SECOND, THIRD, FOURTH, LAST = SNAPSHOTS
NEXT = "2002-01-31"
#: Two snapshots arrive after newer ones.
ARRIVAL = (FIRST, THIRD, LAST, SECOND, FOURTH)
BUCKETS = 8

Query = Callable[[Warehouse], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _at(df: DataFrame, snapshot: str) -> DataFrame:
    return df.filter(F.col(SNAPSHOT) == F.to_date(F.lit(snapshot)))


def _silver(w: Warehouse, root: str, order: tuple[str, ...], gold: Layer | None = None) -> Layer:
    """Silver published snapshot by snapshot, from where it is written, Gold following each."""
    layer = Layer(w.spark, f"{root}/silver")
    for snapshot in order:
        commit = layer.begin()
        for entity in ENTITIES:
            commit.adopt_snapshots(entity, w.path(entity), w.table(entity).schema, [snapshot])
        commit.publish(publish.SILVER_JOB, snapshot)
        if gold is not None:
            publish.publish_pending(layer, gold, BUCKETS)
    return layer


def _published(w: Warehouse) -> tuple[Layer, Layer]:
    def build():
        root = scratch_path(w.spark, "published")
        gold = Layer(w.spark, f"{root}/gold")
        return _silver(w, root, ARRIVAL, gold), gold

    return w.once("published", build)


def _dimension(w: Warehouse, name: str) -> DataFrame:
    return _published(w)[1].table(name).drop(dimensions.SEEN)


@query
def dim_artist_increment(w):
    """Snapshots applied one at a time, two of them late: the same as from all of Silver."""
    return _dimension(w, "dim_artist")


@query
def dim_album_increment(w):
    return _dimension(w, "dim_album")


@query
def dim_track_increment(w):
    return _dimension(w, "dim_track")


@query
def dim_album_rerun(w):
    """The last snapshot comes again without its singles: they fall back to older snapshots, or go."""
    root = scratch_path(w.spark, "rerun")
    source, layer = Layer(w.spark, f"{root}/silver"), Layer(w.spark, f"{root}/gold")
    albums = w.table("albums")
    for rows in (albums, _at(albums, LAST).filter("album_type <> 'single'")):
        commit = source.begin()
        commit.replace_snapshots("albums", rows)
        commit.publish()
        commit = layer.begin()
        dimensions.apply_snapshot(commit, source, dimensions.DIMENSIONS[1], LAST, BUCKETS)
        commit.publish()
    return layer.table("dim_album").drop(dimensions.SEEN)


@query
def fact_published(w):
    return _published(w)[1].table("fact_artist_snapshot").select(
        "artist_id", SNAPSHOT, "total_tracks", "catalog_growth_pct", "catalog_momentum_index")


@query
def published_parts(w):
    """Rows of every table and snapshot of both layers, read off the manifests."""
    source, gold = _published(w)
    return source.parts().unionByName(gold.parts()).select("table_name", SNAPSHOT, "row_count")


@query
def published_versions(w):
    """The fact's rows as of every version."""
    gold = _published(w)[1]
    return reduce(DataFrame.unionByName, [
        gold.table("fact_artist_snapshot", version=v).groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(v).alias("version"), SNAPSHOT, "row_count") for v in gold.versions()])


@query
def published_latest(w):
    """The newest snapshot of the fact, by the manifest."""
    return _published(w)[1].latest("fact_artist_snapshot")


@query
def mart_from_published(w):
    """The momentum mart in SQL over views of one published version."""
    _published(w)[1].register_views("dim_artist", "dim_album", "dim_track", "fact_artist_snapshot")
    w.table("dim_date").createOrReplaceTempView("dim_date")
    marts.register_mart_views(w.spark)
    return w.spark.sql("SELECT * FROM mart_artist_momentum")


@query
def published_pending(w):
    """What Gold has to do when three snapshots of five are processed: asked of the manifests alone."""
    def build():
        root = scratch_path(w.spark, "pending")
        source, gold = _silver(w, root, ARRIVAL), Layer(w.spark, f"{root}/gold")
        for snapshot in (LAST, FIRST, THIRD):
            commit = gold.begin()
            commit.replace_snapshots("artists", _at(w.table("artists"), snapshot))
            commit.publish(publish.GOLD_JOB, snapshot)
        return source, gold

    source, gold = w.once("pending", build)
    waiting = source.pending("artists", publish.GOLD_JOB, gold)
    parts = source.parts("artists", "tracks").filter(F.col(SNAPSHOT).cast("string").isin(waiting))
    return parts.select("table_name", SNAPSHOT, "row_count")


@query
def silver_published_run(w):
    """The gated run with one commit per snapshot, each of them twice."""
    layer = Layer(w.spark, f"{scratch_path(w.spark, 'gated')}/silver")
    bronze = scratch_path(w.spark, "gated-bronze")
    for entity in ENTITIES:
        # A task holds all snapshots of its rows: gathering them would shuffle every row once per snapshot.
        T.write_snapshot(w.bronze(entity), f"{bronze}/{entity}", gather=False)
    sources = {e: T.scan_snapshot(w.spark, f"{bronze}/{e}") for e in ENTITIES}
    for snapshot in (*SNAPSHOTS, SECOND):
        try:
            publish.publish_silver(sources, layer, snapshot)
        except silver.GateFailed:
            # Expected for the shrunken snapshot: its report is published, no rows are.
            pass
    names = {f"silver_{e}": e for e in ENTITIES} | {f"quarantine_{e}": f"rejected_{e}" for e in ("albums", "tracks")}
    rows = reduce(DataFrame.unionByName, [
        layer.table(name).groupBy(SNAPSHOT).agg(F.lit(shown).alias("output"), F.count(F.lit(1)).alias("row_count")) for shown, name in names.items()])
    return layer.table("dq_summary").select(SNAPSHOT, "overall_status").join(rows, SNAPSHOT, "left")


# --- Landing -----------------------------------------------------------------


@query
def corrupt_array_split(w):
    """JSON arrays of all entities and snapshots; every 29th element is cut off in the middle."""
    root = scratch_path(w.spark, "corrupt-arrays")
    parts = []
    for entity in ENTITIES:
        _land_damaged(w, root, entity, SNAPSHOTS)
        for snapshot in SNAPSHOTS:
            # Both sides read what is parsed once.
            elements = R.array_elements(w.spark, root, entity, snapshot).select("external_uri", "extracted_at", "file", "position", R.CORRUPT)
            path = f"{root}/elements/{entity}_{snapshot}"
            elements.write.parquet(path)
            good, bad = R.corrupt_array_split(w.spark.read.schema(elements.schema).parquet(path))
            label = (F.lit(entity).alias("entity"), F.lit(snapshot).cast("date").alias(SNAPSHOT))
            parts.append(good.groupBy().agg(F.count(F.lit(1)).alias("n"), F.count("extracted_at").alias("stamped"), F.count_distinct("external_uri").alias("links")).select(
                *label, F.lit("good").alias("kind"), "n", "stamped", "links"))
            link = F.regexp_extract(R.CORRUPT, r'"(catalog:[^"]+)"', 1)
            parts.append(bad.groupBy().agg(F.count(F.lit(1)).alias("n"), F.count("file").alias("stamped"), F.count_distinct(link).alias("links")).select(
                *label, F.lit("bad").alias("kind"), "n", "stamped", "links"))
    return reduce(DataFrame.unionByName, parts)


def _land_damaged(w: Warehouse, root: str, entity: str, snapshots: tuple[str, ...]) -> None:
    raw = w.raw(entity, snapshots)
    damaged = F.regexp_extract("external_uri", r":([0-9]+)", 1).cast("bigint") % 29 == 0
    broken = F.concat(F.lit('{"snapshot_date": "'), F.col("external_uri"), F.lit('", "artist_na'))
    paths = {s: {R.landing_path(root, entity, s): 1} for s in snapshots}
    R.write_raw_folders(raw, SNAPSHOT, paths, 20_000, F.when(damaged, broken).otherwise(F.to_json(F.struct(*raw.columns))))


@query
def corrupt_array_rows(w):
    """Every column of the albums that survive around damaged elements."""
    root = scratch_path(w.spark, "corrupt-albums")
    parts = []
    _land_damaged(w, root, "albums", SNAPSHOTS)
    for snapshot in SNAPSHOTS:
        parts.append(R.corrupt_array_split(R.array_elements(w.spark, root, "albums", snapshot))[0])
    return reduce(DataFrame.unionByName, parts)


@query
def bronze_with_quarantine(w):
    """Bronze of damaged arrays, run twice: rows that landed and rows that were put aside."""
    root = scratch_path(w.spark, "tolerant")
    for entity in ENTITIES:
        _land_damaged(w, f"{root}/raw", entity, (FOURTH,))
    for _ in range(2):
        bronze.bronze_snapshot(w.spark, f"{root}/raw", f"{root}/bronze", FOURTH, quarantine_root=f"{root}/quarantine")
    read = w.spark.read.parquet
    counted = F.count(F.lit(1)).alias("row_count")
    return reduce(DataFrame.unionByName, [
        part for e in ENTITIES for part in (
            read(f"{root}/bronze/{e}").groupBy(SNAPSHOT).agg(F.lit(e).alias("entity"), F.lit("landed").alias("output"), counted),
            read(f"{root}/quarantine/{e}").groupBy(SNAPSHOT).agg(F.lit(e).alias("entity"), F.max("dq_rule").alias("output"), counted))])


def _landed_twice(w: Warehouse, entity: str) -> DataFrame:
    """Two runs; the second brings files again under other names, and one that holds some records twice."""
    root = scratch_path(w.spark, "repeats")
    # Different tracks may share a link here.
    key = ("external_uri", *(("track_name", "duration_ms") if entity == "tracks" else ()), SNAPSHOT)

    def land(names: dict[str, dict[str, int]]) -> None:
        paths = {s: {f"{root}/raw/{name}.json": copies for name, copies in some.items()} for s, some in names.items()}
        R.write_raw_folders(w.raw(entity, tuple(names)), SNAPSHOT, paths, rows_per_file=20_000)

    def run() -> None:
        incremental_landing(
            w.spark, f"{root}/raw/*.json", entity, f"{root}/bronze", f"{root}/checkpoint", repeat_key=key).awaitTermination()

    land({FIRST: {f"a_{FIRST}": 1, "again": 1}, SECOND: {f"a_{SECOND}": 1}, FOURTH: {f"a_{FOURTH}": 1}})
    run()
    land({SECOND: {"later": 1}, LAST: {"twice": 2}, THIRD: {"late": 1}})
    run()
    return w.spark.read.parquet(f"{root}/bronze").drop(BATCH)


@query
def landing_with_repeats_artists(w):
    return _landed_twice(w, "artists")


@query
def landing_with_repeats_albums(w):
    return _landed_twice(w, "albums")


@query
def landing_with_repeats_tracks(w):
    return _landed_twice(w, "tracks")


# --- Intervals ---------------------------------------------------------------


def _merged_log(w: Warehouse, entity: str, delta_wins: bool, base: str, change: str) -> DataFrame:
    """The log after a merge, written as two partitions, and read for both snapshots."""
    key, path = ENTITY_KEY[entity], scratch_path(w.spark, f"log-{entity}")
    T.write_snapshot(intervals.opened(_at(w.table(entity), base), base), path, gather=False)
    log = w.spark.read.parquet(path)
    for _ in range(2):  # the second run overwrites its own partition
        # Only earlier partitions of the log are read, so the rows need not be staged.
        T.write_snapshot(intervals.changes(log, _at(w.table(entity), change), key, NEXT, delta_wins), path, gather=False)
    return intervals.expanded(w.spark.read.parquet(path), key, (base, NEXT))


@query
def interval_scan_artists(w):
    return _merged_log(w, "artists", True, THIRD, FOURTH).select("artist_id", "artist_name", "extracted_at", SNAPSHOT)


@query
def interval_scan_albums(w):
    return _merged_log(w, "albums", False, SECOND, LAST).select("album_id", "album_name", "extracted_at", SNAPSHOT)


@query
def interval_scan_tracks(w):
    return _merged_log(w, "tracks", False, SECOND, LAST).select("track_id", "track_name", "duration_ms", "extracted_at", SNAPSHOT)


# --- Ranks, bitmaps, fingerprints, sizes -------------------------------------


@query
def rank_any_key(w):
    """About as many distinct leading values as rows."""
    tracks = w.table("tracks").select("track_id", SNAPSHOT, "duration_ms", "track_number")
    return ranking.dense_rank_any(tracks, ["duration_ms", "track_number"], "length_rank")


@query
def rank_any_key_per_snapshot(w):
    tracks = w.table("tracks").select("track_id", SNAPSHOT, "duration_ms")
    return ranking.dense_rank_any(tracks, ["duration_ms"], "length_rank", [SNAPSHOT])


@query
def presence_gaps(w):
    return joins.presence_gaps(w.table("artists"))


@query
def differing_rows(w):
    """Two snapshots as multisets, compared by fingerprints first."""
    tracks = w.table("tracks")
    return checks.differing_rows(_at(tracks, FOURTH), _at(tracks, LAST), ["track_id", "track_name", "duration_ms"])


@query
def parquet_footprint(w):
    """Rows of Silver and of the dimensions, from footers; their sizes are tested against the file system."""
    w.gold_root()
    w.silver()
    folders = {(e, "silver"): w.path(e) for e in ENTITIES} | {(e, "gold"): w.path(f"dim_{e[:-1]}") for e in ENTITIES}
    found = T.parquet_footprint(w.spark, folders, "silver")
    return found.select("entity", "layer", "row_count", ((F.col("bytes") > 0) & (F.col("file_count") > 0)).alias("has_files"))
