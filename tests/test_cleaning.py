from __future__ import annotations

from support import day, records, stamp
from pyspark.sql import functions as F

from snapcat.functions import cleaning as C
from snapcat.model import ENTITIES, RAW_SCHEMAS, raw_schema
from snapcat.plans import bronze, silver
import pytest

BRONZE_ARTIST = (
    "artist_id string, artist_name string, external_uri string, image_url string, genres array<string>, "
    "extracted_at timestamp, snapshot_date date, source string, ingestion_timestamp timestamp"
)
BRONZE_ALBUM = (
    "album_id string, album_name string, album_type string, release_date string, release_date_precision string, "
    "total_tracks string, artist_id string, artist_name string, external_uri string, image_url string, "
    "extracted_at timestamp, snapshot_date date, source string, ingestion_timestamp timestamp"
)
BRONZE_TRACK = (
    "track_id string, track_name string, duration_ms string, explicit string, track_number string, "
    "disc_number string, album_id string, artist_id string, external_uri string, extracted_at timestamp, "
    "snapshot_date date, source string, ingestion_timestamp timestamp"
)
D, T1, T2 = day("2024-05-01"), stamp("2024-05-01T10:00:00"), stamp("2024-05-01T11:00:00")


def test_schemas_declare_keys():
    assert set(RAW_SCHEMAS) == set(ENTITIES)
    for entity, key in (("artists", "artist_id"), ("albums", "album_id"), ("tracks", "track_id")):
        fields = {f.name: f for f in raw_schema(entity).fields}
        assert not fields[key].nullable and not fields["snapshot_date"].nullable
    for call in (lambda: raw_schema("labels"), lambda: bronze.to_bronze("labels", None),
                 lambda: silver.to_silver("labels", None)):
        with pytest.raises(ValueError):
            call()


def test_bronze_artist_is_trimmed_and_stamped(spark):
    raw = spark.createDataFrame(
        [("  a1 ", " Name  ", "uri", None, ["pop"], "2024-05-01T10:00:00+00:00", "2024-05-01")],
        RAW_SCHEMAS["artists"],
    )
    row = bronze.bronze_artists(raw, source="feed").first()
    assert (row.artist_id, row.artist_name, row.genres, row.source) == ("a1", "Name", ["pop"], "feed")
    assert row.extracted_at == T1 and row.snapshot_date == D and row.ingestion_timestamp is not None


def test_bronze_survives_unreadable_text(spark):
    raw = spark.createDataFrame([("a1", "n", None, None, None, "yesterday", "someday")], RAW_SCHEMAS["artists"])
    row = bronze.bronze_artists(raw).first()
    assert row.extracted_at is None and row.snapshot_date is None


def test_bronze_track_defaults(spark):
    raw = spark.createDataFrame(
        [(" t1", "n", 1000, None, 1, None, "al1 ", "a1", None, None, "2024-05-01"),
         ("t2", "n", 1000, True, 1, 2, "al1", "a1", None, None, "2024-05-01")],
        RAW_SCHEMAS["tracks"],
    )
    rows = records(bronze.bronze_tracks(raw), "track_id")
    assert [(r["track_id"], r["album_id"], r["explicit"], r["disc_number"]) for r in rows] == [
        ("t1", "al1", False, 1), ("t2", "al1", True, 2)]


def test_artist_keys_are_cleaned_before_dedupe(spark):
    df = spark.createDataFrame(
        [("  art_001  ", " Old ", " u ", None, None, T1, D, "s", T1),
         ("art_001", "New", "u", None, ["k-pop"], T2, D, "s", T1),
         ("art_002", "Other", None, None, None, T1, D, "s", T1)],
        BRONZE_ARTIST,
    )
    rows = records(silver.silver_artists(df), "artist_id")
    assert [(r["artist_id"], r["artist_name"], r["genres"]) for r in rows] == [
        ("art_001", "New", ["k-pop"]), ("art_002", "Other", [])]


def test_dedupe_scope(spark):
    later = day("2024-06-01")
    df = spark.createDataFrame(
        [("a", "May", None, None, [], T1, D, "s", T1), ("a", "June", None, None, [], T2, later, "s", T1)],
        BRONZE_ARTIST,
    )
    assert silver.silver_artists(df).count() == 2
    assert [r["artist_name"] for r in records(silver.silver_artists(df, per_snapshot=False))] == ["June"]


def test_dedupe_is_deterministic_under_ties(spark):
    rows = [("a", f"Name {i}", None, None, [], T1, D, "s", T1) for i in range(200)]
    for seed in (1, 2, 3):
        df = spark.createDataFrame(rows, BRONZE_ARTIST).repartition(7).orderBy(F.rand(seed))
        assert [r["artist_name"] for r in records(silver.silver_artists(df))] == ["Name 0"]


def album(i, date, kind="album", tracks="10", at=T1):
    return (i, f" N{i} ", kind, date, " DAY ", tracks, "a1", "A", None, None, at, D, "s", T1)


def test_albums_with_mixed_dates(spark):
    df = spark.createDataFrame(
        [album(" al1", "1982", "ALBUM"), album("al1 ", "1982", "ALBUM", at=T2), album("al2", "2020-07", " Single "),
         album("al3", "2024-04-19", tracks=""), album("al4", "N/A", tracks="null"), album("al5", " null "),
         album("al6", "2024-02-31", tracks="many"), album("al7", "19"), album("al8", "garbage!")],
        BRONZE_ALBUM,
    )
    rows = {r["album_id"]: r for r in records(silver.silver_albums(df))}
    got = {k: (r["release_date"], r["release_year"], r["release_month"], r["release_decade"]) for k, r in rows.items()}
    assert got == {
        "al1": (day("1982-01-01"), 1982, 1, "1980s"),
        "al2": (day("2020-07-01"), 2020, 7, "2020s"),
        "al3": (day("2024-04-19"), 2024, 4, "2020s"),
        "al4": (None, None, None, None),
        "al5": (None, None, None, None),
        # The parts come from the text, so they survive an impossible day.
        "al6": (None, 2024, 2, "2020s"),
        "al7": (None, None, None, None),
        "al8": (None, None, None, None),
    }
    assert rows["al1"]["album_type"] == "album" and rows["al2"]["album_type"] == "single"
    assert rows["al1"]["release_date_precision"] == "day" and rows["al1"]["extracted_at"] == T2
    assert [rows[k]["total_tracks"] for k in ("al1", "al3", "al4", "al6")] == [10, None, None, None]


def test_tracks_from_text(spark):
    def track(i, ms, explicit="true", number=" 3 ", at=T1):
        return (i, " n ", ms, explicit, number, "x", "al1", "a1", None, at, D, "s", T1)

    df = spark.createDataFrame(
        [track("t1", "1", at=T1), track("t1 ", " 231826 ", at=T2), track("t2", "180000", "no idea"), track("t3", None)],
        BRONZE_TRACK,
    )
    rows = {r["track_id"]: r for r in records(silver.silver_tracks(df))}
    assert len(rows) == 3
    assert (rows["t1"]["duration_ms"], rows["t1"]["duration_min"], rows["t1"]["duration_sec"]) == (231826, 3.86, 231.8)
    assert (rows["t2"]["duration_min"], rows["t2"]["duration_sec"], rows["t2"]["explicit"]) == (3.0, 180.0, None)
    assert rows["t1"]["explicit"] is True and rows["t1"]["track_number"] == 3 and rows["t1"]["disc_number"] is None
    assert rows["t3"]["duration_min"] is None


def test_since_filters_differ_on_partial_dates(spark):
    df = spark.createDataFrame([("2023",), ("2023-05",), ("2023-05-02",), ("2023-04-30",), ("",), (None,)], "d string")
    text = {r["d"] for r in records(df.filter(C.since_text_filter(F.col("d"), "2023-05-01")))}
    dates = {r["d"] for r in records(df.filter(C.since_date_filter(F.col("d"), "2023-05-01")))}
    assert text == {"2023-05-02", "", None}
    assert dates == {"2023-05", "2023-05-02", "", None}


def test_known_month_only(spark):
    df = spark.createDataFrame([("1999",), ("1999-08",), (None,)], "d string")
    rows = df.select(C.release_month(F.col("d")).alias("m"), C.release_month(F.col("d"), True).alias("k")).collect()
    assert [(r.m, r.k) for r in rows] == [(1, None), (8, 8), (None, None)]
