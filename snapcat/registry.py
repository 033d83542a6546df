"""One runnable query per operator, over the driver tables.

Each query is a function of (warehouse); :func:`registered` turns it into the
``(spark, sf_dir)`` form.  Audit timestamps of the current run are left out of the
results, and arrays are shown as text, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat import registry_layers
from snapcat.functions import cleaning as C
from snapcat.functions import display, metrics
from snapcat.model import ENTITIES, ENTITY_KEY, SNAPSHOT
from snapcat.operators import aggregates as A
from snapcat.operators import checks, dedupe, joins, ledger, merge, quality, ranking
from snapcat.operators import windows as W
from snapcat.plans import analyses, bronze, gold, marts, profile, reads, silver
from snapcat.session import scratch_path
from snapcat.sources import raw as R
from snapcat.sources import tables as T
from snapcat.sources.driver_tables import SNAPSHOTS
from snapcat.streaming.landing import BATCH, incremental_landing
from snapcat.warehouse import Warehouse, open_warehouse

FIRST, SECOND, THIRD, FOURTH, LAST = SNAPSHOTS
NEXT = "2002-01-31"
SOME_ARTIST = "Customer#000000009"
SOME_ARTISTS = (SOME_ARTIST, "Customer#000000019", "Customer#000000101")
LINK = "https://catalog.example/"
AUDIT = ("ingestion_timestamp", "silver_transformed_at", "gold_transformed_at", "quarantined_at")

Query = Callable[[Warehouse], DataFrame]
_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def shown(df: DataFrame) -> DataFrame:
    out = df.drop(*AUDIT)
    return out.withColumn("genres", F.array_join("genres", "|")) if "genres" in out.columns else out


def _day(text: str):
    return F.to_date(F.lit(text))


def _at(df: DataFrame, snapshot: str) -> DataFrame:
    return df.filter(F.col(SNAPSHOT) == _day(snapshot))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: shown(fn(open_warehouse(spark, sf_dir)))

    return {name: bind(fn) for name, fn in (_registry | registry_layers.QUERIES).items()}


# --- Scans, sources, sinks ---------------------------------------------------


def _land_arrays(w: Warehouse, root: str, entity: str, snapshot: str) -> None:
    raw = w.raw(entity, (snapshot,))
    R.write_raw_arrays(raw, R.landing_path(root, entity, snapshot), rows_per_file=20_000)


@query
def scan_raw_json(w):
    root = scratch_path(w.spark, "raw")
    _land_arrays(w, root, "albums", LAST)
    return R.scan_raw_json(w.spark, root, "albums", LAST)


@query
def scan_snapshot(w):
    w.table("albums")
    return T.scan_snapshot(w.spark, w.path("albums"), LAST)


@query
def register_gold_views(w):
    names = T.register_gold_views(w.spark, w.gold_root())
    counts = " UNION ALL ".join(f"SELECT '{n}' AS view_name, COUNT(*) AS row_count FROM {n}" for n in names)
    return w.spark.sql(counts)


@query
def gold_view_join(w):
    T.register_gold_views(w.spark, w.gold_root())
    return w.spark.sql(
        """
        SELECT d.year, d.month_name, f.snapshot_date, a.artist_name, f.total_tracks, f.recent_releases_12m,
               f.median_release_cadence_days, f.catalog_growth_pct, f.catalog_momentum_index
        FROM fact_artist_snapshot f
        JOIN dim_artist a ON f.artist_key = a.artist_key
        LEFT JOIN dim_date d ON f.date_key = d.date_key
        """
    )


@query
def write_snapshot(w):
    path = scratch_path(w.spark, "write-snapshot")
    albums = w.table("albums")
    T.write_snapshot(albums, path)
    # A rerun of one snapshot with fewer rows replaces that partition only.
    T.write_snapshot(_at(albums, LAST).filter(F.col("album_type") == "album"), path)
    return T.scan_snapshot(w.spark, path).select("album_id", "album_type", "release_date", SNAPSHOT)


@query
def write_dimension(w):
    path = scratch_path(w.spark, "write-dimension")
    T.write_dimension(w.dim("album"), path)
    T.write_dimension(gold.dim_artist(w.table("artists")), path)
    return w.spark.read.parquet(path)


def _orphan_albums(w: Warehouse) -> DataFrame:
    return joins.orphans_by_keys(w.table("albums"), w.table("artists"), "artist_id", within=[SNAPSHOT])


@query
def quarantine(w):
    path = scratch_path(w.spark, "quarantine")
    rejected = quality.quarantine(_orphan_albums(w), "referential_integrity", "orphan_artist_id")
    T.write_quarantine(rejected, path)
    return w.spark.read.parquet(path).select("album_id", "artist_id", "dq_rule", "dq_reason", SNAPSHOT)


@query
def quarantine_rerun(w):
    """The second run of a gate replaces what the first one rejected."""
    path = scratch_path(w.spark, "quarantine")
    for _ in range(2):
        T.write_quarantine(quality.quarantine(_orphan_albums(w), "referential_integrity", "orphan_artist_id"), path)
    return w.spark.read.parquet(path).select("album_id", "artist_id", "dq_rule", "dq_reason", SNAPSHOT)


@query
def write_dq_report(w):
    path = scratch_path(w.spark, "dq-report")
    results = w.gate()
    details, summary = T.write_dq_report(results, quality.dq_report(results), path)
    read = w.spark.read.parquet
    return read(details).join(
        read(summary).select(SNAPSHOT, "overall_status", "success_rate_pct"), SNAPSHOT
    )


@query
def generate_calendar(w):
    return T.calendar_of(w.source("orders"), "o_orderdate")


@query
def storage_footprint(w):
    """Against plain JSON lines, which land gzipped and are measured as they read."""
    return T.storage_footprint(_layers(w), "raw", line_layers=("raw",))


@query
def footprint_rows(w):
    """Rows per layer against what the source holds: cleaning drops repeated keys."""
    expected = {entity: w.raw(entity).count() for entity in ENTITIES}
    found = T.storage_footprint(_layers(w), "raw", expected)
    return found.filter(F.col("entity") != "TOTAL").select("entity", "layer", "row_count", "rows_as_expected")


def _layers(w: Warehouse) -> dict[tuple[str, str], DataFrame]:
    root = scratch_path(w.spark, "footprint")
    layers = {}
    for entity in ENTITIES:
        landed = R.write_raw_lines(w.raw(entity), f"{root}/raw/{entity}", R.LANDED)
        layers[entity, "raw"] = w.spark.read.text(landed)
        layers[entity, "silver"] = w.table(entity)
    return layers


@query
def corrupt_record_split(w):
    """Every 29th customer's record is cut off in the middle, in each of the snapshots."""
    root = scratch_path(w.spark, "corrupt")
    custkey = F.substring_index(F.col("external_uri"), ":", -1).cast("bigint")
    parts = []
    for snapshot in SNAPSHOTS:
        raw = w.raw("artists", (snapshot,))
        document = F.to_json(F.struct(*raw.columns))
        broken = F.concat(F.lit('{"artist_id": "'), custkey.cast("string"), F.lit('", "artist_na'))
        lines = raw.select(F.when(custkey % 29 == 0, broken).otherwise(document).alias("value"))
        lines.write.text(R.landing_path(root, "artists", snapshot))
        good, bad = R.corrupt_record_split(
            R.scan_raw_json(w.spark, root, "artists", snapshot, multi_line=False, keep_corrupt=True)
        )
        parts.append(good.select(F.lit("good").alias("kind"), F.col("external_uri").alias("record")))
        parts.append(bad.select(F.lit("bad").alias("kind"), F.col(R.CORRUPT).alias("record")))
    return reduce(DataFrame.unionByName, parts)


# --- Projections, filters, predicates ----------------------------------------


@query
def bronze_artists(w):
    return bronze.bronze_artists(w.raw("artists"))


@query
def bronze_albums(w):
    return bronze.bronze_albums(w.raw("albums"))


@query
def bronze_tracks(w):
    return bronze.bronze_tracks(w.raw("tracks"))


@query
def bronze_snapshot(w):
    root = scratch_path(w.spark, "bronze-snapshot")
    for entity in ENTITIES:
        _land_arrays(w, f"{root}/raw", entity, LAST)
    counts = bronze.bronze_snapshot(w.spark, f"{root}/raw", f"{root}/bronze", LAST)
    parts = [
        T.scan_snapshot(w.spark, f"{root}/bronze/{entity}", LAST).groupBy(SNAPSHOT).agg(
            F.lit(entity).alias("entity"),
            F.count(F.lit(1)).alias("rows_read_back"),
            F.lit(counts[entity]).cast("bigint").alias("rows_written"),
        )
        for entity in ENTITIES
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def silver_snapshot(w):
    root = scratch_path(w.spark, "silver-snapshot")
    for entity in ENTITIES:
        T.write_snapshot(_at(w.bronze(entity), LAST), f"{root}/bronze/{entity}")
    counts = silver.silver_snapshot(w.spark, f"{root}/bronze", f"{root}/silver", LAST)
    parts = [
        T.scan_snapshot(w.spark, f"{root}/silver/{entity}").groupBy(SNAPSHOT).agg(
            F.lit(entity).alias("entity"),
            F.count(F.lit(1)).alias("rows_read_back"),
            F.lit(counts[entity]).cast("bigint").alias("rows_written"),
        )
        for entity in ENTITIES
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def clean_artists(w):
    return silver.clean_artists(w.bronze("artists"))


@query
def clean_albums(w):
    return silver.clean_albums(w.bronze("albums")).drop("source")


@query
def clean_tracks(w):
    return silver.clean_tracks(w.bronze("tracks")).drop("source")


def _release_text(w: Warehouse) -> DataFrame:
    return w.bronze("albums").withColumn("release_text", C.nullify_sentinels(F.col("release_date")))


@query
def nullify_sentinels(w):
    return _release_text(w).select("album_id", SNAPSHOT, "release_text")


@query
def normalize_partial_date(w):
    return _release_text(w).select(
        "album_id", SNAPSHOT, C.normalize_partial_date(F.col("release_text")).alias("release_date")
    )


@query
def derive_release_parts(w):
    text = F.col("release_text")
    year = C.release_year(text)
    return _release_text(w).select(
        "album_id", SNAPSHOT, year.alias("release_year"), C.release_month(text).alias("release_month"),
        C.release_month(text, only_known=True).alias("known_month"), C.decade_label(year).alias("release_decade"),
    )


@query
def derive_durations(w):
    ms = C.whole_number("duration_ms", "bigint")
    return w.bronze("tracks").select(
        "external_uri", SNAPSHOT, ms.alias("duration_ms"), C.duration_minutes(ms).alias("duration_min"),
        C.duration_seconds(ms).alias("duration_sec"),
    )


@query
def normalize_track_types(w):
    return w.bronze("tracks").select(
        "external_uri", SNAPSHOT, C.whole_number("explicit", "boolean").alias("explicit"),
        C.whole_number("track_number", "int").alias("track_number"),
        C.whole_number("disc_number", "int").alias("disc_number"),
    )


@query
def normalize_categories(w):
    return w.bronze("albums").select(
        "album_id", SNAPSHOT, F.lower(C.trimmed("album_type")).alias("album_type"),
        F.lower(C.trimmed("release_date_precision")).alias("release_date_precision"),
    )


@query
def latest_snapshot_filter(w):
    return T.latest_snapshot_filter(w.fact())


@query
def asof_release_filter(w):
    return w.table("albums").filter(A.released()).select("album_id", SNAPSHOT, "release_date")


@query
def since_filter(w):
    kept = w.bronze("albums").filter(C.since_text_filter(F.col("release_date"), "1999-01-01"))
    return kept.select("album_id", SNAPSHOT, "release_date")


@query
def since_filter_by_date(w):
    kept = w.bronze("albums").filter(C.since_date_filter(F.col("release_date"), "1999-01-01"))
    return kept.select("album_id", SNAPSHOT, "release_date")


@query
def explore_tracks(w):
    return reads.explore_tracks(
        w.dim("track"), w.dim("album"), w.dim("artist"), LINK + "track/", SOME_ARTISTS, ("album", "single"), limit=500
    )


@query
def explore_all_tracks(w):
    """The whole catalogue."""
    return reads.explore_tracks(w.dim("track"), w.dim("album"), w.dim("artist"), LINK + "track/")


@query
def range_filters(w):
    return w.table("tracks").filter(
        (F.col("duration_ms") > 0) & (F.col("duration_ms") < 1_200_000) & F.col("track_number").between(2, 5)
    ).select("track_id", SNAPSHOT, "duration_ms", "track_number")


@query
def display_track_columns(w):
    shown_tracks = reads.display_tracks(w.dim("track"), LINK + "track/")
    return shown_tracks.select(
        "track_id", "duration_text", "track_url", "length_compact", "length_grouped"
    )


@query
def display_artist_columns(w):
    return reads.display_artists(w.momentum(), w.activity())


# --- Joins -------------------------------------------------------------------


@query
def snapshot_grid_join(w):
    artists, albums, tracks = w.silver()
    parts = [A.album_counts(albums), A.track_counts(tracks)]
    return joins.snapshot_grid_join(artists, parts, zero_filled=gold.COUNTS)


@query
def fact_dim_join(w):
    joined = joins.fact_dim_join(w.fact(), w.dim("artist"), "artist_key", ["artist_name"])
    return joined.select("artist_key", SNAPSHOT, "artist_name", "total_tracks", "catalog_momentum_index")


@query
def orphan_audit_left_join(w):
    known = w.dim("artist").filter(F.col("image_url").isNotNull())
    return joins.orphan_audit_left_join(w.fact(), known, "artist_key")


@query
def orphans_anti(w):
    return _orphan_albums(w).select("album_id", "artist_id", SNAPSHOT)


@query
def keep_with_parent_semi(w):
    kept = joins.keep_with_parent_semi(w.table("tracks"), w.table("albums"), "album_id", within=[SNAPSHOT])
    return kept.select("track_id", "album_id", SNAPSHOT)


@query
def orphans_null_filter(w):
    """Dimension-level orphans: left join and a NULL test, as an anti-join."""
    found = joins.orphans_anti(w.dim("track"), w.dim("album"), "album_key")
    return found.select("track_id", "album_id")


@query
def track_album_artist_join(w):
    return joins.track_album_artist_join(w.dim("track"), w.dim("album"), w.dim("artist")).drop("album_key")


@query
def artist_profile(w):
    return reads.artist_profile(w.momentum(), w.activity(), w.dim("artist"), SOME_ARTIST, LAST)


@query
def agg_self_join(w):
    monthly = A.releases_by_artist_month(w.dim("album"), w.dim("artist"))
    return A.agg_self_join(monthly, "artist_name", "releases_in_month", "lifetime_releases", "share_pct")


@query
def presence_matrix(w):
    return joins.presence_matrix(w.table("artists"), w.table("tracks"), SNAPSHOTS)


@query
def missing_later(w):
    return joins.missing_later(w.table("artists"), SECOND, THIRD)


# --- Aggregations ------------------------------------------------------------


@query
def track_counts(w):
    return A.track_counts(w.bronze("tracks"))


@query
def album_counts(w):
    return A.album_counts(silver.clean_albums(w.bronze("albums")))


@query
def median_cadence(w):
    return W.median_cadence(W.release_gaps(w.table("albums")))


@query
def exact_median_cadence(w):
    return W.exact_median_cadence(W.release_gaps(w.table("albums")))


@query
def metric_distribution(w):
    return A.metric_distribution(profile.profile_snapshot(*w.silver()), profile.PROFILED)


@query
def format_counts_by_month(w):
    return A.format_counts_by_month(w.dim("album"))


@query
def format_evolution_by_year(w):
    return A.format_evolution_by_year(w.dim("album"), 1970, 2026)


@query
def explicit_ratio(w):
    return A.explicit_ratio(w.dim("track"), w.dim("album"), w.dim("artist"))


@query
def cohort_sanity(w):
    return A.cohort_sanity(w.fact(), w.dim("artist"))


@query
def executive_kpis(w):
    return A.executive_kpis(w.fact(), LAST)


@query
def strategy_distribution(w):
    return reads.strategy_distribution(marts.strategy_mix(w.fact()), LAST)


@query
def warehouse_health(w):
    return reads.warehouse_health(
        w.fact(), w.dim("artist"), w.dim("album"), w.dim("track"), w.gate_summary()
    )


@query
def fact_rollup_by_snapshot(w):
    return A.fact_rollup_by_snapshot(w.fact())


@query
def duplicate_key_groups(w):
    return A.duplicate_key_groups(w.bronze("tracks"), ["track_id", SNAPSHOT])


@query
def cohort_growth(w):
    return W.cohort_growth(w.fact())


@query
def catalog_trends(w):
    _, albums, tracks = w.silver()
    return A.catalog_trends(albums, tracks)


@query
def duration_histogram(w):
    return A.duration_histogram(reads.duration_rows(w.dim("track"), w.dim("album"), w.dim("artist"), 1_200_000))


# --- Windows -----------------------------------------------------------------


@query
def dedupe_latest(w):
    """No snapshot in the key: all snapshots collapse to the latest record."""
    latest = dedupe.dedupe_latest(silver.clean_tracks(w.bronze("tracks")), ["track_id"])
    return latest.select("track_id", "track_name", "duration_ms", "explicit", SNAPSHOT)


@query
def scd1_latest(w):
    return dedupe.scd1_latest(w.table("albums"), ["album_id"]).select("album_id", "album_name", SNAPSHOT)


@query
def release_gaps(w):
    return W.release_gaps(w.table("albums"))


@query
def growth_pct(w):
    counts = A.track_counts(w.table("tracks"), keys_unique=True)
    return W.growth_pct(counts)


@query
def prev_value_lag(w):
    lagged = W.prev_value_lag(w.fact(), "total_tracks", "prev_tracks")
    return lagged.select("artist_key", SNAPSHOT, "total_tracks", "prev_tracks")


@query
def rank_per_snapshot(w):
    return ranking.rank_per_snapshot(
        w.fact().select("artist_id", SNAPSHOT, "recent_releases_12m", "total_tracks"),
        ["recent_releases_12m", "total_tracks"], "activity_rank",
    )


@query
def rank_global(w):
    return ranking.rank_global(
        w.fact().select("artist_id", SNAPSHOT, "median_release_cadence_days"),
        ["median_release_cadence_days"], "cadence_rank",
    )


@query
def peak_per_group(w):
    monthly = w.table("albums").filter("release_month IS NOT NULL").groupBy("artist_id", SNAPSHOT, "release_month").agg(
        F.count(F.lit(1)).alias("n")
    )
    return W.peak_per_group(
        monthly, ["artist_id", SNAPSHOT], [F.col("n").desc(), F.col("release_month").asc()]
    )


# --- Sort, limit, set operations ---------------------------------------------


@query
def ordered_topn(w):
    joined = marts.with_artist(w.fact(), w.dim("artist")).select(
        SNAPSHOT, "artist_name", "total_tracks", "recent_releases_12m", "catalog_momentum_index"
    )
    order = [F.desc(SNAPSHOT), F.col("catalog_momentum_index").desc_nulls_last(), F.col("artist_name").asc()]
    return reads.ordered_topn(joined, order, 25)


@query
def distinct_values(w):
    return reads.distinct_values(w.table("tracks"), ["artist_id", SNAPSHOT])


@query
def snapshot_dates(w):
    return reads.snapshot_dates(w.fact())


@query
def artist_list(w):
    return reads.artist_list(w.dim("artist"))


@query
def drop_null_sort(w):
    return reads.drop_null_sort(
        w.fact().select("artist_id", SNAPSHOT, "median_release_cadence_days"), "median_release_cadence_days"
    )


def _merged(w: Warehouse, entity: str, key: str, delta_wins: bool, base: str, change: str) -> DataFrame:
    table = w.table(entity)
    return merge.incremental_merge(_at(table, base), _at(table, change), key, NEXT, delta_wins)


@query
def incremental_merge_artists(w):
    merged = _merged(w, "artists", "artist_id", True, THIRD, FOURTH)
    return merged.select("artist_id", "artist_name", "extracted_at", SNAPSHOT)


@query
def incremental_merge_albums(w):
    merged = _merged(w, "albums", "album_id", False, SECOND, LAST)
    return merged.select("album_id", "album_name", "extracted_at", SNAPSHOT)


@query
def incremental_merge(w):
    merged = _merged(w, "tracks", "track_id", False, SECOND, LAST)
    return merged.select("track_id", "track_name", "duration_ms", "extracted_at", SNAPSHOT)


def _whole_merge(w: Warehouse) -> dict[str, DataFrame]:
    prior, delta = ({e: _at(w.table(e), day) for e in ENTITIES} for day in (SECOND, LAST))
    return merge.merge_snapshot(prior, delta, NEXT)


@query
def merge_snapshot(w):
    """Three tables carried forward and merged: every key of the new snapshot."""
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(entity).alias("entity"), F.col(ENTITY_KEY[entity]).alias("id"), SNAPSHOT)
        for entity, df in _whole_merge(w).items()
    ])


@query
def merge_snapshot_orphans(w):
    """Tracks of the merged snapshot without their album there, against those of its two sources."""
    found = joins.orphan_counts(*(_whole_merge(w)[e] for e in ("tracks", "albums")), "album_id", within=[SNAPSHOT])
    return found.select(SNAPSHOT, "total_rows", "orphan_count")


@query
def track_cache_reuse(w):
    history, delta = _at(w.table("tracks"), SECOND), _at(w.table("albums"), THIRD)
    known, unknown = merge.split_known_releases(delta, history)
    reused = merge.track_cache_reuse(history, known, NEXT)
    return reused.select(
        F.lit("reused").alias("action"), F.col("track_id").alias("id"), SNAPSHOT
    ).unionByName(unknown.select(F.lit("fetch").alias("action"), F.col("album_id").alias("id"), SNAPSHOT))


@query
def dedupe_first_seen(w):
    """Pages of every snapshot; ids are seen anew in each."""
    pages = w.bronze("tracks").withColumn(
        "page_key", F.when(F.col("duration_ms") % 31 != 0, F.struct("track_id", SNAPSHOT))
    )
    first = dedupe.dedupe_first_seen(pages, "page_key", "extracted_at")
    return first.select("track_id", SNAPSHOT, "track_name", "duration_ms", "extracted_at")


# --- Ledger and idempotence --------------------------------------------------


def _sample_ledger(w: Warehouse) -> str:
    path = scratch_path(w.spark, "ledger")
    ledger.commit_snapshot(w.spark, path, "nightly", SECOND)
    ledger.reset_ledger(w.spark, path, "nightly")
    ledger.commit_snapshot(w.spark, path, "nightly", THIRD, metadata="rows=1")
    ledger.commit_snapshot(w.spark, path, "nightly", FIRST)
    ledger.commit_snapshot(w.spark, path, "nightly", FIRST)
    ledger.commit_snapshot(w.spark, path, "other", LAST)
    return path


@query
def pending_snapshots(w):
    entries = ledger.ledger_entries(w.spark, _sample_ledger(w))
    return ledger.pending_snapshots(w.table("tracks"), entries, "nightly")


@query
def commit_snapshot(w):
    """Processed snapshots of a job with the rows they hold."""
    state = ledger.ledger_state(ledger.ledger_entries(w.spark, _sample_ledger(w)))
    sizes = w.table("tracks").groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("row_count"))
    return sizes.join(state.drop("committed_at"), SNAPSHOT)


@query
def verify_idempotent(w):
    before = w.fact()
    path = scratch_path(w.spark, "fact-rerun")
    for _ in range(2):
        T.write_snapshot(gold.fact_artist_snapshot(*w.silver(), snapshot=LAST, keys_unique=True), path)
    return checks.verify_idempotent(
        _at(before, LAST), w.spark.read.parquet(path), w.dim("artist"), ["artist_key", SNAPSHOT], "artist_key",
        ignore=AUDIT,
    )


@query
def row_differences(w):
    """The same rows at two snapshots, compared as multisets."""
    columns = ["track_id", "track_name", "duration_ms"]
    tracks = w.table("tracks")
    return checks.row_differences(_at(tracks, FOURTH), _at(tracks, LAST), columns)


@query
def contract_check(w):
    w.gold_root()
    tables = {name: w.table(name).drop(*AUDIT) for name in T.GOLD_TABLES}
    tables |= {"mart_artist_activity": w.activity(), "mart_artist_momentum": w.momentum()}
    contracts = {
        "dim_date": (1000, [c for c in tables["dim_date"].columns]),
        "dim_artist": (1, ["artist_key", "artist_id", "artist_name", "genres", "external_uri", "image_url"]),
        "dim_album": (1_000_000_000, tables["dim_album"].columns),
        "dim_track": (1, ["track_key", "track_id"]),
        "fact_artist_snapshot": (1, tables["fact_artist_snapshot"].columns),
        "mart_artist_activity": (1, marts.ACTIVITY_COLUMNS),
        "mart_artist_momentum": (1, marts.MOMENTUM_COLUMNS),
    }
    return checks.contract_check(tables, contracts)


# --- Data quality ------------------------------------------------------------


@query
def dq_completeness(w):
    return quality.dq_completeness(w.table("artists"), "artists", min_expected=55)


@query
def dq_completeness_empty(w):
    """No rows at all: a FAIL, not an empty report."""
    nothing = w.table("artists").filter(F.col(SNAPSHOT).isNull())
    return quality.dq_completeness(nothing, "artists", min_expected=1)


@query
def dq_uniqueness(w):
    return quality.dq_uniqueness(w.bronze("tracks"), "tracks", ["track_id"])


@query
def dq_critical_nulls(w):
    albums = silver.clean_albums(w.bronze("albums"))
    return quality.dq_critical_nulls(albums, "albums", ["album_id", "release_date", "image_url"])


@query
def dq_referential(w):
    return quality.dq_referential(w.table("albums"), w.table("artists"), "artist_id", "albums", "artists")


@query
def dq_value_ranges(w):
    return quality.dq_value_ranges(
        w.table("tracks"), "tracks",
        bounds={"duration_ms": (10_000, 400_000), "track_number": (None, 6)},
        allowed={"disc_number": [1], "track_number": [1, 2, 3, 4]},
    )


@query
def dq_report(w):
    return quality.dq_report(w.gate())


@query
def quality_gate(w):
    return w.gate()


def _gated(w: Warehouse, runs: int) -> DataFrame:
    root = scratch_path(w.spark, "gated")
    for entity in ENTITIES:
        T.write_snapshot(w.bronze(entity), f"{root}/bronze/{entity}")
    for snapshot in SNAPSHOTS * runs:
        try:
            silver.silver_gated_run(
                w.spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", f"{root}/report", snapshot
            )
        except silver.GateFailed:
            # Expected for the shrunken snapshot: its report is kept, no rows are.
            pass
    outputs = {f"silver_{e}": f"{root}/silver/{e}" for e in ENTITIES}
    outputs |= {f"quarantine_{e}": f"{root}/quarantine/{e}" for e in ("albums", "tracks")}
    rows = reduce(
        DataFrame.unionByName,
        [
            w.spark.read.parquet(path).groupBy(SNAPSHOT).agg(
                F.lit(name).alias("output"), F.count(F.lit(1)).alias("row_count")
            )
            for name, path in outputs.items()
        ],
    )
    summary = w.spark.read.parquet(f"{root}/report/summary").select(SNAPSHOT, "overall_status")
    return summary.join(rows, SNAPSHOT, "left")


@query
def silver_gated_run(w):
    """All snapshots: the gate warns about four and rejects one."""
    return _gated(w, 1)


@query
def silver_gated_rerun(w):
    """Running them all again changes nothing."""
    return _gated(w, 2)


@query
def route_orphans_cascade(w):
    routed = silver.route_orphans(*w.silver(), cascade=True)
    return routed.tracks.select("track_id", SNAPSHOT, F.lit("kept").alias("route")).unionByName(
        routed.rejected_tracks.select("track_id", SNAPSHOT, F.lit("quarantined").alias("route"))
    )


@query
def dq_release_not_future(w):
    return quality.dq_release_not_future(w.table("albums"))


# --- Scalars and metrics -----------------------------------------------------


@query
def scalar_string(w):
    name = F.col("album_name")
    return w.table("albums").select(
        "album_id", SNAPSHOT, F.lower(name).alias("lowered"), F.length(name).alias("name_length"),
        F.substring(name, 1, 4).alias("prefix"), F.concat(F.lit("<"), F.trim(name), F.lit(">")).alias("wrapped"),
        F.col("album_type").isin("album", "single").alias("is_main_format"), F.md5("album_id").alias("digest"),
        F.col("release_date").cast("string").alias("release_text"),
    )


@query
def scalar_date(w):
    day = F.col("release_date")
    return w.table("albums").select(
        "album_id", SNAPSHOT, metrics.date_key(day).alias("date_key"), F.year(day).alias("year"),
        F.quarter(day).alias("quarter"), F.month(day).alias("month"), F.dayofmonth(day).alias("day_of_month"),
        metrics.iso_weekday(day).alias("weekday"), F.weekofyear(day).alias("week"),
        F.date_format(day, "MMMM").alias("month_name"), F.date_format(day, "EEEE").alias("day_name"),
        F.date_sub(day, 365).alias("year_before"), F.datediff(F.col(SNAPSHOT), day).alias("age_days"),
    )


@query
def scalar_month_name(w):
    return w.table("albums").select(
        "album_id", SNAPSHOT, metrics.month_name(F.col("release_month")).alias("month_name"),
        F.year("release_date").alias("release_year"),
    )


@query
def scalar_math(w):
    albums, singles = F.col("total_albums"), F.col("total_singles")
    return w.fact().select(
        "artist_id", SNAPSHOT, metrics.pct(singles, albums + singles).alias("single_pct"),
        metrics.ratio(singles, albums).alias("ratio"), F.floor(F.col("total_tracks") / 10).alias("tens"),
        F.least(albums, singles).alias("smaller"), F.greatest(albums, singles).alias("larger"),
        (F.col("total_tracks") % 7).alias("remainder"),
    )


@query
def scalar_conditional(w):
    growth = F.col("catalog_growth_pct")
    return w.fact().select(
        "artist_id", SNAPSHOT, F.coalesce(growth, F.lit(-1.0)).alias("growth_or_minus_one"),
        F.nullif(F.col("total_albums"), F.lit(0)).alias("albums_or_null"), growth.isNull().alias("is_first"),
        F.when(growth > 0, "up").when(growth < 0, "down").otherwise("other").alias("direction"),
        F.substring(F.col("artist_id"), 2, 9).try_cast("int").alias("artist_no"),
    )


@query
def scalar_array(w):
    """Years from an artist's first to last release, one row each."""
    spans = w.table("albums").filter(F.col("release_year").isNotNull()).groupBy("artist_id").agg(
        F.min("release_year").alias("first"), F.max("release_year").alias("last")
    )
    years = spans.select("artist_id", F.sequence("first", "last").alias("years"))
    return years.select("artist_id", F.size("years").alias("span"), F.explode("years").alias("active_year"))


@query
def surrogate_keys(w):
    return w.table("tracks").select(
        "track_id", SNAPSHOT, metrics.surrogate_key(F.col("track_id")).alias("track_key"),
        metrics.surrogate_key(F.col("album_id")).alias("album_key"),
        metrics.surrogate_key(F.col("artist_id")).alias("artist_key"),
        metrics.date_key(F.col(SNAPSHOT)).alias("date_key"),
    )


def _over_fact(w: Warehouse, **columns) -> DataFrame:
    return w.fact().select("artist_id", SNAPSHOT, *(c.alias(n) for n, c in columns.items()))


RECENT, GROWTH, CADENCE, INDEX = (
    "recent_releases_12m", "catalog_growth_pct", "median_release_cadence_days", "catalog_momentum_index"
)


@query
def score_recent(w):
    return _over_fact(w, score=metrics.score_recent(F.col(RECENT)))


@query
def score_growth(w):
    return _over_fact(w, score=metrics.score_growth(F.col(GROWTH)))


@query
def score_cadence(w):
    return _over_fact(w, score=F.round(metrics.score_cadence(F.col(CADENCE)), 6))


@query
def momentum_index(w):
    return _over_fact(w, momentum=metrics.momentum_index(F.col(RECENT), F.col(GROWTH), F.col(CADENCE)))


@query
def momentum_pillars(w):
    return _over_fact(w, **metrics.momentum_pillars(F.col(RECENT), F.col(GROWTH), F.col(CADENCE)))


@query
def momentum_tier(w):
    return _over_fact(w, tier=metrics.momentum_tier(F.col(INDEX)), badge=display.momentum_badge(F.col(INDEX)))


@query
def trajectory(w):
    lagged = W.prev_value_lag(w.fact(), INDEX, "prev")
    return lagged.select(
        "artist_id", SNAPSHOT, metrics.momentum_delta(F.col(INDEX), F.col("prev")).alias("delta"),
        metrics.trajectory(F.col(INDEX), F.col("prev")).alias("direction"),
    )


@query
def strategy_by_ratio(w):
    ratio = metrics.ratio(F.col("total_singles"), F.col("total_albums"))
    return _over_fact(w, strategy=metrics.strategy_by_ratio(ratio))


@query
def strategy_by_share(w):
    share = metrics.pct(F.col("total_singles"), F.col("total_albums") + F.col("total_singles"), None)
    return _over_fact(w, strategy=metrics.strategy_by_share(share))


@query
def activity_tier(w):
    return _over_fact(w, tier=metrics.activity_tier(F.col(RECENT)))


@query
def growth_class(w):
    lagged = W.prev_value_lag(w.fact(), "total_tracks", "prev")
    return lagged.select(
        "artist_id", SNAPSHOT,
        metrics.growth_class_by_count(F.col("total_tracks"), F.col("prev")).alias("by_count"),
        metrics.growth_class_by_pct(F.col(GROWTH)).alias("by_pct"),
    )


@query
def season_archetype(w):
    albums = w.table("albums").filter(F.col("release_month").isNotNull())
    return albums.select(
        "album_id", SNAPSHOT, metrics.season_archetype(F.col("release_month")).alias("archetype")
    )


# --- Composite tables, marts, analyses, reads --------------------------------


@query
def silver_artists(w):
    return silver.silver_artists(w.bronze("artists"))


@query
def silver_albums(w):
    return silver.silver_albums(w.bronze("albums"))


@query
def silver_tracks(w):
    return silver.silver_tracks(w.bronze("tracks"))


@query
def dim_date(w):
    return gold.calendar_attributes(T.calendar_of(w.source("orders"), "o_orderdate"))


@query
def dim_artist(w):
    return gold.dim_artist(w.table("artists"))


@query
def dim_album(w):
    return gold.dim_album(w.table("albums"))


@query
def dim_track(w):
    return gold.dim_track(w.table("tracks"))


@query
def snapshot_base(w):
    return gold.snapshot_base(*w.silver(), keys_unique=True)


@query
def snapshot_base_any_keys(w):
    """The same measures without relying on unique keys."""
    return gold.snapshot_base(*w.silver())


@query
def fact_artist_snapshot(w):
    return gold.fact_artist_snapshot(*w.silver(), keys_unique=True)


@query
def fact_at_snapshot(w):
    return gold.fact_artist_snapshot(*w.silver(), snapshot=LAST, keys_unique=True)


@query
def fact_increment(w):
    return gold.fact_increment(*w.silver(), w.fact(), LAST, keys_unique=True)


@query
def build_gold(w):
    """All snapshots, then one of them again on top of its history."""
    root = scratch_path(w.spark, "gold")
    w.silver()
    source = w.path("artists").rsplit("/", 1)[0]
    gold.build_gold(w.spark, source, root, keys_unique=True)
    counts = gold.build_gold(w.spark, source, root, snapshot=LAST, keys_unique=True)
    written = F.create_map(*(F.lit(v) for pair in counts.items() for v in pair))
    parts = [
        w.spark.read.parquet(f"{root}/{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for name in T.GOLD_TABLES
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.withColumn("last_written", written[F.col("table_name")].cast("bigint"))


def _built(w: Warehouse, order: tuple[str, ...]) -> DataFrame:
    """The fact after building snapshots one by one, as they become available in Silver."""
    root = scratch_path(w.spark, "gold")
    seen: list[str] = []
    for snapshot in order:
        seen.append(snapshot)
        for entity in ENTITIES:
            T.write_snapshot(_at(w.table(entity), snapshot), f"{root}/silver/{entity}", gather=False)
        gold.build_gold(w.spark, f"{root}/silver", f"{root}/gold", snapshot=snapshot, keys_unique=True)
    return w.spark.read.parquet(f"{root}/gold/fact_artist_snapshot").select(
        "artist_id", SNAPSHOT, "total_tracks", "catalog_growth_pct", "catalog_momentum_index"
    )


@query
def build_gold_stepwise(w):
    """From nothing, one snapshot after the other."""
    return _built(w, SNAPSHOTS)


@query
def build_gold_backfill(w):
    """The third snapshot arrives last, in the middle of the history."""
    return _built(w, (*SNAPSHOTS[:2], *SNAPSHOTS[3:], SNAPSHOTS[2]))


@query
def register_mart_views(w):
    """A question asked in SQL over the views."""
    T.register_gold_views(w.spark, w.gold_root())
    marts.register_mart_views(w.spark)
    return w.spark.sql(
        """
        SELECT a.catalog_strategy, m.momentum_tier, g.growth_classification, m.snapshot_date,
               COUNT(*) AS artists, SUM(m.total_tracks) AS tracks
        FROM mart_artist_momentum m
        JOIN mart_artist_activity a ON m.artist_key = a.artist_key AND m.snapshot_date = a.snapshot_date
        JOIN mart_catalog_growth g ON m.artist_key = g.artist_key AND m.snapshot_date = g.snapshot_date
        GROUP BY a.catalog_strategy, m.momentum_tier, g.growth_classification, m.snapshot_date
        """
    )


@query
def mart_artist_activity(w):
    return w.activity()


@query
def mart_artist_activity_latest(w):
    return marts.mart_artist_activity_latest(w.fact(), w.dim("artist"))


@query
def mart_catalog_growth(w):
    return marts.mart_catalog_growth(w.fact(), w.dim("artist"))


@query
def mart_release_seasonality(w):
    return marts.mart_release_seasonality(w.dim("album"))


@query
def mart_artist_momentum(w):
    return w.momentum()


@query
def mart_artist_momentum_latest(w):
    return marts.mart_artist_momentum_latest(w.fact(), w.dim("artist"))


@query
def q1_top_active(w):
    return analyses.q1_top_active(w.fact(), w.dim("artist"))


@query
def q2_format_mix(w):
    return analyses.q2_format_mix(w.fact(), w.dim("artist"))


@query
def q3_growth_velocity(w):
    return analyses.q3_growth_velocity(w.fact(), w.dim("artist"))


@query
def q4_net_tracks_added(w):
    return analyses.q4_net_tracks_added(w.fact(), w.dim("artist"))


@query
def q5_monthly_distribution(w):
    return analyses.q5_monthly_distribution(w.dim("album"))


@query
def q6_peak_month(w):
    return analyses.q6_peak_month(w.dim("album"), w.dim("artist"))


@query
def q7_momentum_leaderboard(w):
    return analyses.q7_momentum_leaderboard(w.fact(), w.dim("artist"))


@query
def q8_momentum_delta(w):
    return analyses.q8_momentum_delta(w.fact(), w.dim("artist"))


@query
def artist_activity_at(w):
    return reads.artist_activity_at(w.fact(), w.dim("artist"), FOURTH)


@query
def artist_momentum_at(w):
    return reads.artist_momentum_at(w.momentum(), FOURTH)


@query
def catalog_growth_all(w):
    return reads.catalog_growth_all(marts.mart_catalog_growth(w.fact(), w.dim("artist")))


@query
def release_seasonality_all(w):
    return reads.release_seasonality_all(marts.mart_release_seasonality(w.dim("album")))


@query
def artist_trajectory(w):
    return reads.artist_trajectory(w.fact(), w.dim("artist"), SOME_ARTIST)


@query
def artist_discography(w):
    return reads.artist_discography(w.dim("album"), w.dim("artist"), SOME_ARTIST, LINK + "album/")


@query
def duration_rows(w):
    return reads.duration_rows(w.dim("track"), w.dim("album"), w.dim("artist"), 1_200_000)


@query
def profile_snapshot(w):
    return profile.profile_snapshot(*w.silver())


# --- Streaming ---------------------------------------------------------------


def _landed(w: Warehouse, entity: str) -> DataFrame:
    """JSON arrays: all snapshots but two land, then the newest together with a late one."""
    root = scratch_path(w.spark, "landing")
    for part in (SNAPSHOTS[:1] + SNAPSHOTS[2:-1], SNAPSHOTS[1:2] + SNAPSHOTS[-1:]):
        R.write_raw_folders(w.raw(entity, part), SNAPSHOT, {s: {f"{root}/raw/{entity}_{s}.json": 1} for s in part}, rows_per_file=20_000)
        incremental_landing(
            w.spark, f"{root}/raw/*.json", entity, f"{root}/bronze", f"{root}/checkpoint"
        ).awaitTermination()
    return w.spark.read.parquet(f"{root}/bronze").drop(BATCH)


@query
def incremental_landing_artists(w):
    return _landed(w, "artists")


@query
def incremental_landing_albums(w):
    return _landed(w, "albums")


@query
def incremental_landing_tracks(w):
    return _landed(w, "tracks")


@query
def landing_after_batch(w):
    """One Bronze table, fed by a batch load of the last snapshot and by the stream."""
    root = scratch_path(w.spark, "landing")
    for entity in ENTITIES:
        _land_arrays(w, f"{root}/batch", entity, LAST)
    bronze.bronze_snapshot(w.spark, f"{root}/batch", f"{root}/bronze", LAST)
    earlier = SNAPSHOTS[:-1]
    R.write_raw_folders(w.raw("albums", earlier), SNAPSHOT, {s: {f"{root}/raw/albums_{s}.json": 1} for s in earlier}, rows_per_file=20_000)
    incremental_landing(
        w.spark, f"{root}/raw/*.json", "albums", f"{root}/bronze/albums", f"{root}/checkpoint"
    ).awaitTermination()
    return w.spark.read.parquet(f"{root}/bronze/albums").drop(BATCH)
