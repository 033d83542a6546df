"""Silver and Gold runs that publish all their tables in one commit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat import model as M
from snapcat.model import ENTITIES, SNAPSHOT
from snapcat.operators import quality
from snapcat.plans import dimensions, gold
from snapcat.plans.silver import GateFailed, route_orphans, to_silver
from snapcat.session import scratch_path
from snapcat.sources.layers import Layer

SILVER_JOB, GOLD_JOB = "silver", "gold"
FACT = "fact_artist_snapshot"


def _staged(df: DataFrame, name: str) -> DataFrame:
    """Written once and read back with the declared schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_silver(
    bronze: Mapping[str, DataFrame],
    silver: Layer,
    snapshot: str,
    max_orphan_pct: float = M.MAX_ORPHAN_PCT,
    track_bounds: Mapping[str, tuple] = M.TRACK_BOUNDS,
    cascade: bool = False,
) -> int:
    """Gate one snapshot of Bronze and publish what passes, its rejects and its report together; the version.

    A snapshot that fails publishes its report only and raises :class:`GateFailed`; rows of an earlier run stay.
    """
    spark, day = silver.spark, F.to_date(F.lit(snapshot))
    commit = silver.begin()
    tables = {e: _staged(to_silver(e, bronze[e].filter(F.col(SNAPSHOT) == day)), f"candidates-{e}") for e in ENTITIES}
    results = _staged(
        quality.quality_gate(
            *(tables[e] for e in ENTITIES), max_orphan_pct=max_orphan_pct, track_bounds=track_bounds,
            expected=quality.expected_snapshots(spark, [snapshot])), "gate")
    commit.replace_snapshots("dq_results", results)
    commit.replace_snapshots("dq_summary", quality.dq_report(results))
    # At most 13 rows.
    failures = [
        f"{r.entity} {r.rule} {r.target} ({r.violations:,})"
        for r in results.filter(F.col("status") == quality.FAIL).select("entity", "rule", "target", "violations").collect()
    ]
    if failures:
        commit.publish()
        raise GateFailed(snapshot, failures)
    routed = route_orphans(*(tables[e] for e in ENTITIES), cascade)
    outputs = {
        "artists": tables["artists"],
        "albums": routed.albums.select(*tables["albums"].columns),
        "tracks": routed.tracks.select(*tables["tracks"].columns),
        "rejected_albums": routed.rejected_albums,
        "rejected_tracks": routed.rejected_tracks,
    }
    for name, df in outputs.items():
        commit.replace_snapshots(name, df, [snapshot])
    return commit.publish(SILVER_JOB, snapshot)


def publish_gold(silver: Layer, layer: Layer, snapshot: str, buckets: int = 64, keys_unique: bool = True) -> int:
    """Bring Gold up to one more snapshot of Silver: three dimensions and the fact in one commit; the version.

    Reads that snapshot, the stored dimensions and the fact's counts.  A snapshot before others changes the growth of the
    one after it, which is computed anew as well.
    """
    commit = layer.begin()
    for dimension in dimensions.DIMENSIONS:
        dimensions.apply_snapshot(commit, silver, dimension, snapshot, buckets)
    later = [s for s in layer.snapshots(FACT) if s > snapshot][:1]
    history = None
    if layer.has(FACT):
        history = layer.table(FACT).filter(F.col(SNAPSHOT) != F.to_date(F.lit(snapshot))).select("artist_id", SNAPSHOT, "total_tracks")
    fact = None
    for day in (snapshot, *later):
        rows = tuple(silver.table(e, snapshot=day) for e in ENTITIES)
        known = fact.select("artist_id", SNAPSHOT, "total_tracks") if fact is not None else None
        if history is not None and known is not None:
            # The successor looks back on the snapshot just computed too.
            known = history.unionByName(known)
        elif history is not None:
            known = history
        new = gold.fact_increment(*rows, known, day, keys_unique) if known is not None else gold.fact_artist_snapshot(*rows, keys_unique=keys_unique)
        new = _staged(new, f"fact-{day}")
        fact = new if fact is None else fact.unionByName(new)
    commit.replace_snapshots(FACT, fact, [snapshot])
    return commit.publish(GOLD_JOB, snapshot)


def publish_pending(silver: Layer, layer: Layer, buckets: int = 64) -> list[int]:
    """Gold for every snapshot that Silver has and Gold has not processed, oldest first; the versions."""
    return [publish_gold(silver, layer, s, buckets) for s in silver.pending("artists", GOLD_JOB, layer)]
