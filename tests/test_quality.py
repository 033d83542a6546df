from __future__ import annotations

import pytest
from support import day, records

from snapcat.operators import quality as Q

D1, D2 = day("2024-01-31"), day("2024-02-29")


def one(df):
    rows = records(df)
    assert len(rows) == 1
    return rows[0]


def test_completeness(spark):
    df = spark.createDataFrame([("a", D1), ("b", D1)], "artist_id string, snapshot_date date")
    assert one(Q.dq_completeness(df, "artists"))["status"] == "PASS"
    short = one(Q.dq_completeness(df, "artists", min_expected=10))
    assert (short["status"], short["total_rows"], short["violations"]) == ("FAIL", 2, 8)


def test_absent_snapshot_fails_completeness(spark):
    df = spark.createDataFrame([("a", D1)], "artist_id string, snapshot_date date")
    expected = Q.expected_snapshots(spark, ["2024-01-31", "2024-02-29"])
    rows = records(Q.dq_completeness(df, "artists", expected=expected), "snapshot_date")
    assert [(r["status"], r["total_rows"]) for r in rows] == [("PASS", 1), ("FAIL", 0)]
    unique = records(Q.dq_uniqueness(df, "artists", ["artist_id"], expected), "snapshot_date")
    assert [(r["status"], r["rate_pct"]) for r in unique] == [("PASS", 0.0), ("PASS", 0.0)]


def test_uniqueness(spark):
    df = spark.createDataFrame(
        [("t1", "x", D1), ("t2", "x", D1), ("t1", "y", D1)], "track_id string, title string, snapshot_date date"
    )
    row = one(Q.dq_uniqueness(df, "tracks", ["track_id"]))
    assert (row["status"], row["violations"], row["rate_pct"], row["detail"]) == ("FAIL", 1, 33.33, "distinct_keys=2")
    assert one(Q.dq_uniqueness(df, "tracks", ["track_id", "title"]))["status"] == "PASS"


def test_null_counts_as_one_key(spark):
    df = spark.createDataFrame([(None, D1), (None, D1), ("a", D1)], "artist_id string, snapshot_date date")
    row = one(Q.dq_uniqueness(df, "artists", ["artist_id"]))
    assert (row["violations"], row["detail"]) == (1, "distinct_keys=2")


def test_critical_nulls(spark):
    df = spark.createDataFrame(
        [(None, "n", "a", D1), ("t", "   ", "a", D1), ("u", "n", None, D1)],
        "track_id string, track_name string, artist_id string, snapshot_date date",
    )
    row = one(Q.dq_critical_nulls(df, "tracks", ["track_id", "track_name", "artist_id"]))
    assert (row["status"], row["violations"], row["detail"]) == ("FAIL", 3, "track_id=1,track_name=1,artist_id=1")


@pytest.mark.parametrize(
    "good,bad,status,rate", [(2, 0, "PASS", 0.0), (99, 1, "WARN", 1.0), (95, 5, "WARN", 5.0), (90, 10, "FAIL", 10.0)]
)
def test_referential_thresholds(spark, good, bad, status, rate):
    child = [(f"t{i}", "al1", D1) for i in range(good)] + [(f"x{i}", "gone" if i else None, D1) for i in range(bad)]
    tracks = spark.createDataFrame(child, "track_id string, album_id string, snapshot_date date")
    albums = spark.createDataFrame([("al1", D1), ("al1", D1)], "id string, snapshot_date date")
    row = one(Q.dq_referential(tracks, albums, "album_id", "tracks", "albums", parent_key="id"))
    assert (row["status"], row["violations"], row["rate_pct"], row["total_rows"]) == (status, bad, rate, good + bad)


def test_parent_must_be_in_the_same_snapshot(spark):
    tracks = spark.createDataFrame([("t", "al1", D2)], "track_id string, album_id string, snapshot_date date")
    albums = spark.createDataFrame([("al1", D1)], "album_id string, snapshot_date date")
    assert one(Q.dq_referential(tracks, albums, "album_id", "tracks", "albums"))["violations"] == 1


def test_value_ranges(spark):
    df = spark.createDataFrame(
        [(-500, 1, "x", D1), (1000, 0, "y", D1), (None, None, None, D1), (1000, 9, "x", D1)],
        "duration_ms bigint, track_number int, kind string, snapshot_date date",
    )
    row = one(Q.dq_value_ranges(df, "tracks", {"duration_ms": (1, 7_200_000), "track_number": (1, None)}))
    assert (row["status"], row["violations"], row["detail"]) == ("FAIL", 2, "duration_ms=1,track_number=1")
    both = one(Q.dq_value_ranges(
        df, "tracks", {"track_number": (None, 8)}, {"track_number": [0, 1], "kind": ["x"]}
    ))
    assert both["detail"] == "track_number=1,allowed:track_number=1,allowed:kind=1"
    assert one(Q.dq_value_ranges(df.filter("duration_ms > 0"), "tracks", {"duration_ms": (None, None)}))["status"] == "PASS"


def test_release_not_future(spark):
    df = spark.createDataFrame([(D2, D1), (D1, D1), (None, D1)], "release_date date, snapshot_date date")
    row = one(Q.dq_release_not_future(df))
    assert (row["status"], row["violations"], row["rate_pct"]) == ("FAIL", 1, 33.33)


@pytest.mark.parametrize(
    "statuses,overall,rate", [("PPP", "PASS", 100.0), ("PW", "WARN", 50.0), ("PWF", "FAIL", 33.33), ("F", "FAIL", 0.0)]
)
def test_report(spark, statuses, overall, rate):
    names = {"P": "PASS", "W": "WARN", "F": "FAIL"}
    df = spark.createDataFrame([(names[s], D1) for s in statuses], "status string, snapshot_date date")
    row = one(Q.dq_report(df))
    assert (row["overall_status"], row["success_rate_pct"], row["total_checks"]) == (overall, rate, len(statuses))
    assert row["passed"] == statuses.count("P") and row["warnings"] == statuses.count("W")


def test_quarantine_stamp(spark):
    df = spark.createDataFrame([("t", D1)], "track_id string, snapshot_date date")
    row = one(Q.quarantine(df, "referential_integrity", "orphan_album_id"))
    assert (row["dq_rule"], row["dq_reason"], row["snapshot_date"]) == ("referential_integrity", "orphan_album_id", D1)
    assert row["quarantined_at"] is not None


def test_empty_tables_are_reported(spark):
    empty = spark.createDataFrame([], "artist_id string, snapshot_date date")
    row = Q.dq_completeness(empty, "artists", 1).first()
    assert (row.status, row.total_rows, row.snapshot_date) == ("FAIL", 0, None)
    assert Q.dq_uniqueness(empty, "artists", ["artist_id"]).first().status == "PASS"
    undated = spark.createDataFrame([("a",), ("a",)], "artist_id string")
    row = Q.dq_uniqueness(undated, "artists", ["artist_id"]).first()
    assert (row.status, row.total_rows, row.violations, row.snapshot_date) == ("FAIL", 2, 1, None)
    none = spark.createDataFrame([], "artist_id string")
    assert Q.dq_completeness(none, "artists", 1).first().status == "FAIL"


def test_album_counts_keeps_artists_without_a_release(spark):
    from snapcat.operators.aggregates import album_counts

    rows = spark.sql("""SELECT 'a' AS artist_id, date'2024-01-31' AS snapshot_date, 'x' AS album_id, 'album' AS album_type,
        date'2025-01-01' AS release_date UNION ALL SELECT 'b', date'2024-01-31', 'y', 'single', NULL""")
    for unique in (True, False):
        found = sorted(tuple(r) for r in album_counts(rows, unique).select("artist_id", "total_albums", "total_singles").collect())
        assert found == [("a", 0, 0), ("b", 0, 0)]
