"""Silver: cleaned, conformed, one row per key and snapshot, gated."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat import model as M
from snapcat.functions import cleaning as C
from snapcat.model import ENTITIES, ENTITY_KEY, SNAPSHOT
from snapcat.operators import quality
from snapcat.operators.dedupe import dedupe_latest, dedupe_observed, latest_observed
from snapcat.operators.joins import split_by_keys
from snapcat.plans.bronze import write_counted
from snapcat.sources.tables import clear_quarantine, scan_snapshot, write_quarantine, write_snapshot

LINEAGE = ("extracted_at", SNAPSHOT, "source")


def _with_trimmed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.trim(F.col(name)) for name in names})


def clean_artists(bronze: DataFrame) -> DataFrame:
    return _with_trimmed(bronze, "artist_id", "artist_name", "external_uri").withColumn(
        "genres", C.text_or_empty_array("genres")
    )


def clean_albums(bronze: DataFrame) -> DataFrame:
    """Trimmed text, parsed mixed-precision dates, integer counts, lower-case categories."""
    text = C.nullify_sentinels(F.col("release_date"))
    trimmed = _with_trimmed(bronze, "album_id", "album_name", "artist_id", "artist_name", "external_uri")
    return trimmed.withColumns({
        "album_type": F.lower(C.trimmed("album_type")),
        "release_date_precision": F.lower(C.trimmed("release_date_precision")),
        "total_tracks": C.clean_count(F.col("total_tracks")),
        "release_date": C.normalize_partial_date(text),
        "release_year": C.release_year(text),
        "release_month": C.release_month(text),
        "release_decade": C.decade_label(C.release_year(text)),
    })


def _number(df: DataFrame, name: str, dtype: str) -> Column:
    """Value as ``dtype``; text goes through trim, a column that fits stays as it is."""
    fits = df.schema[name].dataType.simpleString() == dtype
    return F.col(name) if fits else C.whole_number(name, dtype)


def clean_tracks(bronze: DataFrame) -> DataFrame:
    ms = _number(bronze, "duration_ms", "bigint")
    return _with_trimmed(bronze, "track_id", "track_name", "album_id", "artist_id", "external_uri").withColumns({
        "duration_ms": ms,
        "duration_min": C.duration_minutes(ms),
        "duration_sec": C.duration_seconds(ms),
        "explicit": _number(bronze, "explicit", "boolean"),
        "track_number": _number(bronze, "track_number", "int"),
        "disc_number": _number(bronze, "disc_number", "int"),
    })


CLEAN = {"artists": clean_artists, "albums": clean_albums, "tracks": clean_tracks}

SILVER_COLUMNS = {
    "artists": ("artist_id", "artist_name", "external_uri", "image_url", "genres", *LINEAGE),
    "albums": (
        "album_id", "album_name", "album_type", "release_date", "release_year", "release_month",
        "release_decade", "release_date_precision", "total_tracks", "artist_id", "artist_name",
        "external_uri", "image_url", *LINEAGE,
    ),
    "tracks": (
        "track_id", "track_name", "duration_ms", "duration_min", "duration_sec", "explicit",
        "track_number", "disc_number", "album_id", "artist_id", "external_uri", *LINEAGE,
    ),
}


def to_silver(entity: str, bronze: DataFrame, per_snapshot: bool = True) -> DataFrame:
    """Cleaned entity with the latest record per key.

    Keys are cleaned before they are compared.  ``per_snapshot=False`` keeps one
    row per key over everything that was read.
    """
    if entity not in CLEAN:
        raise ValueError(f"unknown entity {entity!r}, expected one of {ENTITIES}")
    keys = [ENTITY_KEY[entity], *([SNAPSHOT] if per_snapshot else [])]
    deduped = dedupe_latest(CLEAN[entity](bronze), keys)
    return deduped.select(*SILVER_COLUMNS[entity], F.current_timestamp().alias("silver_transformed_at"))


def observed_silver(
    entity: str,
    bronze: DataFrame,
    snapshots: Sequence[str],
    extracted_at: Callable[[Column], Column] | None = None,
    newest_only: bool = False,
) -> DataFrame:
    """:func:`to_silver` of rows that stand for several snapshots (see ``dedupe_observed``).

    ``extracted_at`` gives the raw text of that column where it comes from the snapshot.  ``newest_only`` keeps of
    each key the row of its newest snapshot.
    """
    pick = latest_observed if newest_only else dedupe_observed
    deduped = pick(CLEAN[entity](bronze), ENTITY_KEY[entity], snapshots)
    if extracted_at is not None:
        deduped = deduped.withColumn("extracted_at", F.try_to_timestamp(extracted_at(F.col(SNAPSHOT))))
    return deduped.select(*SILVER_COLUMNS[entity], F.current_timestamp().alias("silver_transformed_at"))


def silver_artists(bronze: DataFrame, per_snapshot: bool = True) -> DataFrame:
    return to_silver("artists", bronze, per_snapshot)


def silver_albums(bronze: DataFrame, per_snapshot: bool = True) -> DataFrame:
    return to_silver("albums", bronze, per_snapshot)


def silver_tracks(bronze: DataFrame, per_snapshot: bool = True) -> DataFrame:
    return to_silver("tracks", bronze, per_snapshot)


def silver_snapshot(spark: SparkSession, bronze_root: str, silver_root: str, snapshot: str) -> dict[str, int]:
    """Bronze -> Silver for one snapshot without a gate; rows written per entity."""
    return {
        entity: write_counted(
            to_silver(entity, scan_snapshot(spark, f"{bronze_root}/{entity}", snapshot)),
            f"{silver_root}/{entity}",
            f"silver_{entity}",
        )
        for entity in ENTITIES
    }


class GateFailed(RuntimeError):
    """The quality gate rejected a snapshot; nothing was written to Silver."""

    def __init__(self, snapshot: str, failures: list[str]) -> None:
        super().__init__(f"snapshot {snapshot} rejected: {'; '.join(failures)}")
        self.snapshot, self.failures = snapshot, failures


@dataclass(frozen=True)
class GatedTables:
    """What a gated run would write: accepted rows and quarantined rows."""

    artists: DataFrame
    albums: DataFrame
    tracks: DataFrame
    rejected_albums: DataFrame | None
    rejected_tracks: DataFrame | None


def route_orphans(
    artists: DataFrame, albums: DataFrame, tracks: DataFrame, cascade: bool = False
) -> GatedTables:
    """Accepted and quarantined rows of gated candidates.

    Albums without artist and tracks without album are quarantined; a track whose
    *artist* is missing only raises a warning.  By default a track of a quarantined
    album stays, because its album was a candidate; ``cascade=True`` sends it along.
    """
    good_albums, bad_albums = split_by_keys(albums, artists, "artist_id", within=[SNAPSHOT])
    good_tracks, bad_tracks = split_by_keys(tracks, good_albums if cascade else albums, "album_id", within=[SNAPSHOT])
    rule = "referential_integrity"
    return GatedTables(
        artists, good_albums, good_tracks,
        quality.quarantine(bad_albums, rule, "orphan_artist_id"),
        quality.quarantine(bad_tracks, rule, "orphan_album_id"),
    )


def silver_gated_run(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    quarantine_root: str,
    report_root: str,
    snapshot: str,
    staging_root: str | None = None,
    max_orphan_pct: float = M.MAX_ORPHAN_PCT,
    track_bounds: Mapping[str, tuple] = M.TRACK_BOUNDS,
    cascade: bool = False,
) -> dict:
    """Candidate -> gate -> quarantine -> Silver for one snapshot.

    Candidates are written to a staging table that belongs to Silver and is overwritten
    by the next run of the snapshot: the gate, the quarantine and the final write read
    it with their own columns, and a lost executor costs a re-read, not another dedupe.  A FAIL raises :class:`GateFailed` after the
    report and before anything reaches Silver.
    """
    staging = staging_root or f"{silver_root.rstrip('/')}_candidates"
    tables = {}
    for entity in ENTITIES:
        bronze = scan_snapshot(spark, f"{bronze_root}/{entity}", snapshot)
        write_snapshot(to_silver(entity, bronze), f"{staging}/{entity}", gather=False)
        # Declared schema: an empty candidate has no file to infer one from.
        schema = to_silver(entity, bronze).schema
        tables[entity] = spark.read.schema(schema).parquet(f"{staging}/{entity}").filter(
            F.col(SNAPSHOT) == F.to_date(F.lit(snapshot))
        )

    expected = quality.expected_snapshots(spark, [snapshot])
    results = quality.quality_gate(
        tables["artists"], tables["albums"], tables["tracks"],
        max_orphan_pct=max_orphan_pct, track_bounds=track_bounds, expected=expected,
    )
    write_snapshot(results, f"{report_root}/results")
    results = scan_snapshot(spark, f"{report_root}/results", snapshot)
    write_snapshot(quality.dq_report(results), f"{report_root}/summary")
    # At most 13 rows.
    rows = results.select("rule", "entity", "target", "status", "violations").collect()
    failures = [f"{r.entity} {r.rule} {r.target} ({r.violations:,})" for r in rows if r.status == quality.FAIL]
    if failures:
        raise GateFailed(snapshot, failures)

    warned = {(r.entity, r.target) for r in rows if r.status == quality.WARN}
    albums_hit = ("albums", "artist_id->artists") in warned
    tracks_hit = ("tracks", "album_id->albums") in warned or (cascade and albums_hit)
    # The gate has counted the orphans: no need to look for them again.
    routed = route_orphans(*tables.values(), cascade) if albums_hit or tracks_hit else GatedTables(*tables.values(), None, None)
    for entity, hit, rejected in (("albums", albums_hit, routed.rejected_albums), ("tracks", tracks_hit, routed.rejected_tracks)):
        if hit:
            write_quarantine(rejected, f"{quarantine_root}/{entity}")
        else:
            clear_quarantine(spark, f"{quarantine_root}/{entity}", snapshot, "referential_integrity")
    accepted = {
        "artists": tables["artists"],
        "albums": routed.albums if albums_hit else tables["albums"],
        "tracks": routed.tracks if tracks_hit else tables["tracks"],
    }
    counts = {
        entity: write_counted(df.select(*tables[entity].columns), f"{silver_root}/{entity}", f"gated_{entity}")
        for entity, df in accepted.items()
    }
    status = quality.WARN if any(r.status == quality.WARN for r in rows) else quality.PASS
    return {"snapshot_date": snapshot, "overall_status": status, "counts": counts}
