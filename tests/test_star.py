"""Aggregates, windows and ranks against brute force, with one hot artist."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from collections import defaultdict

import pytest
from support import day, records
from pyspark.sql import functions as F

from snapcat.operators import aggregates as A
from snapcat.operators import joins, ranking
from snapcat.operators import windows as W
from snapcat.plans import gold, profile, reads
from snapcat.sources.tables import generate_calendar

SNAPS = [day("2023-01-31"), day("2023-06-30"), day("2024-01-31")]
ALBUM = "album_id string, artist_id string, album_type string, release_date date, snapshot_date date"


@pytest.fixture(scope="module")
def catalog(spark):
    """A third of all releases belongs to artist a0; some artists have none."""
    rng = random.Random(11)
    artists, albums, tracks = [], [], []
    for s in SNAPS:
        for n in range(30):
            if not (n == 7 and s == SNAPS[1]):
                artists.append((f"a{n}", f"Artist {n}", s))
        for i in range(900):
            artist = "a0" if i % 3 == 0 else f"a{rng.randrange(1, 28)}"
            released = rng.choice([None, s - dt.timedelta(days=rng.randrange(-40, 900))])
            albums.append((f"al{i}", artist, rng.choice(["album", "single", "compilation"]), released, s))
            for k in range(rng.randrange(3)):
                tracks.append((f"t{i}-{k}", f"al{i}", artist, s))
    return (
        spark.createDataFrame(artists, "artist_id string, artist_name string, snapshot_date date"),
        spark.createDataFrame(albums, ALBUM),
        spark.createDataFrame(tracks, "track_id string, album_id string, artist_id string, snapshot_date date"),
    )


def brute_base(artists, albums, tracks):
    out = {}
    alb, trk = defaultdict(list), defaultdict(set)
    for r in albums.collect():
        alb[r.artist_id, r.snapshot_date].append(r)
    for r in tracks.collect():
        trk[r.artist_id, r.snapshot_date].add(r.track_id)
    for r in artists.collect():
        key = (r.artist_id, r.snapshot_date)
        seen = [a for a in alb[key] if a.release_date and a.release_date <= r.snapshot_date]
        days = sorted({a.release_date for a in seen})
        gaps = [(b - a).days for a, b in zip(days, days[1:])]
        floor = r.snapshot_date - dt.timedelta(days=365)
        out[key] = (
            len({a.album_id for a in seen if a.album_type == "album"}),
            len(trk[key]),
            len({a.album_id for a in seen if a.album_type == "single"}),
            len({a.album_id for a in seen if a.album_type in ("album", "single") and a.release_date >= floor}),
            float(statistics.median_low(gaps)) if gaps else None,
        )
    return out


@pytest.mark.parametrize("keys_unique", [True, False])
def test_snapshot_base(catalog, keys_unique):
    got = {
        (r.artist_id, r.snapshot_date): (
            r.total_albums, r.total_tracks, r.total_singles, r.recent_releases_12m, r.median_release_cadence_days
        )
        for r in gold.snapshot_base(*catalog, keys_unique=keys_unique).collect()
    }
    assert got == brute_base(*catalog)


def test_repeated_rows_count_once(catalog):
    artists, albums, tracks = catalog
    doubled = gold.snapshot_base(artists, albums.union(albums), tracks.union(tracks))
    once = gold.snapshot_base(artists, albums, tracks, keys_unique=True)
    assert sorted(doubled.collect(), key=str) == sorted(once.collect(), key=str)


def test_recent_window_includes_both_ends(spark):
    s = day("2024-12-31")
    dates = ["2024-12-31", "2024-01-01", "2023-12-31", "2025-01-01"]
    rows = [(f"al{i}", "a", "single", day(d), s) for i, d in enumerate(dates)]
    row = A.album_counts(spark.createDataFrame(rows, ALBUM)).first()
    # 2024 is a leap year: 365 days before its last day is January 1st.
    assert (row.recent_releases_12m, row.total_singles, row.total_albums) == (2, 3, 0)


def test_medians_of_an_even_number_of_gaps(spark):
    s = day("2024-12-31")
    dates = ["2024-01-01", "2024-01-11", "2024-01-31", "2024-01-31"]
    albums = spark.createDataFrame([(f"al{i}", "a", "album", day(d), s) for i, d in enumerate(dates)], ALBUM)
    gaps = W.release_gaps(albums)
    assert [r.gap_days for r in gaps.orderBy("release_date").collect()] == [10, 20]
    assert W.median_cadence(gaps).first().median_release_cadence_days == 10.0
    assert W.exact_median_cadence(gaps).first().median_cadence_days == 15.0


def test_growth_jumps_over_a_missing_snapshot(catalog):
    fact = gold.fact_artist_snapshot(*catalog, keys_unique=True)
    rows = {r.snapshot_date: r for r in fact.filter("artist_id = 'a7'").collect()}
    assert set(rows) == {SNAPS[0], SNAPS[2]}
    first, last = rows[SNAPS[0]], rows[SNAPS[2]]
    assert first.catalog_growth_pct is None
    expected = round((last.total_tracks - first.total_tracks) / first.total_tracks * 100, 2)
    assert last.catalog_growth_pct == pytest.approx(expected, abs=0.011)


def test_profile_growth_needs_the_directly_preceding_snapshot(catalog):
    artists, albums, tracks = catalog
    with_parts = albums.withColumn("total_tracks", F.lit(1))
    rows = {r.snapshot_date: r for r in profile.profile_snapshot(artists, with_parts, tracks)
            .filter("artist_id = 'a7'").collect()}
    assert rows[SNAPS[2]].growth_pct is None


def test_target_snapshot_still_sees_history(catalog):
    everything = gold.fact_artist_snapshot(*catalog, keys_unique=True)
    target = gold.fact_artist_snapshot(*catalog, snapshot="2023-06-30", keys_unique=True)
    key = ["artist_id", "catalog_growth_pct", "catalog_momentum_index"]
    assert sorted(target.select(*key).collect()) == sorted(
        everything.filter(F.col("snapshot_date") == F.lit(SNAPS[1])).select(*key).collect()
    )
    assert target.filter("catalog_growth_pct IS NOT NULL").count() > 0


def test_increment_equals_full_build(catalog):
    everything = gold.fact_artist_snapshot(*catalog, keys_unique=True).drop("gold_transformed_at")
    for s in SNAPS:
        earlier = everything.filter(F.col("snapshot_date") < F.lit(s))
        step = gold.fact_increment(*catalog, earlier, s.isoformat(), keys_unique=True).drop("gold_transformed_at")
        full = everything.filter(F.col("snapshot_date") == F.lit(s))
        assert sorted(step.collect(), key=str) == sorted(full.collect(), key=str)


def test_calendar_dimension(spark):
    dim = gold.dim_date(spark)
    assert dim.count() == 29_585 and dim.select("date_key").distinct().count() == 29_585
    row = dim.filter("date_key = 20240229").first()
    assert (row.year, row.quarter, row.month_name, row.day_of_week, row.day_name, row.is_weekend) == (
        2024, 1, "February", 4, "Thursday", False)
    assert dim.filter("date_key = 20260830").first().is_weekend
    assert generate_calendar(spark, "2024-02-28", "2024-03-01").count() == 3


def brute_dense(rows, parts, keys):
    groups = defaultdict(set)
    order = lambda r: tuple((r[k] is None, -(r[k] or 0)) for k in keys)
    for r in rows:
        groups[tuple(r[p] for p in parts)].add(order(r))
    ranks = {g: {k: i + 1 for i, k in enumerate(sorted(v))} for g, v in groups.items()}
    return [ranks[tuple(r[p] for p in parts)][order(r)] for r in rows]


@pytest.mark.parametrize("parts", [[], ["p"]])
@pytest.mark.parametrize("keys", [["x"], ["x", "y"], ["x", "y", "z"]])
def test_dense_rank(spark, parts, keys):
    rng = random.Random(len(keys))
    rows = [
        (i, rng.choice("AB"), rng.choice([None, 0, 1, 2, 5]) if i % 3 else 0, rng.randrange(6), rng.randrange(3))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "id int, p string, x int, y int, z int")
    got = sorted(ranking.dense_rank_by(df, keys, "r", parts).collect())
    assert len(got) == 600
    assert [r.r for r in got] == brute_dense(got, parts, keys)


def test_warehouse_health_of_nothing(spark, catalog):
    fact = gold.fact_artist_snapshot(*catalog, keys_unique=True).filter("1 = 0")
    empty = {n: spark.createDataFrame([], f"{n}_key string") for n in ("artist", "album", "track")}
    summary = spark.createDataFrame([], "snapshot_date date, overall_status string")
    row = reads.warehouse_health(fact, empty["artist"], empty["album"], empty["track"], summary).first()
    assert row.latest_snapshot is None and row.dq_status is None
    assert (row.total_snapshots, row.total_facts, row.artists_count) == (0, 0, 0)
    kpis = A.executive_kpis(fact, "2023-06-30").first()
    assert tuple(kpis) == (0, 0, 0, 0, 0, 0.0)


def test_presence(catalog):
    artists, _, tracks = catalog
    texts = [s.isoformat() for s in SNAPS]
    row = joins.presence_matrix(artists, tracks, texts).filter("artist_id = 'a7'").first()
    assert (row.present_20230131, row.present_20230630, row.missing_in) == (True, False, "2023-06-30")
    assert row.tracks_20230630 is None
    gone = records(joins.missing_later(artists, texts[0], texts[1]))
    assert gone == [{"artist_id": "a7", "artist_name": "Artist 7"}]


def test_duration_histogram(spark):
    rng = random.Random(2)
    minutes = [round(rng.uniform(0.5, 12), 2) for _ in range(5000)]
    df = spark.createDataFrame([(m,) for m in minutes], "duration_min double")
    rows = records(A.duration_histogram(df, bins=10), "bin")
    assert sum(r["track_count"] for r in rows) == 5000 and {r["bin"] for r in rows} == set(range(10))
    assert rows[0]["median_min"] == pytest.approx(statistics.median(minutes), abs=1e-4)
    same = spark.createDataFrame([(3.0,)] * 4, "duration_min double")
    assert [(r["bin"], r["track_count"]) for r in records(A.duration_histogram(same))] == [(0, 4)]
