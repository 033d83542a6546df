from __future__ import annotations

import json

import pytest
from support import day, records
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from snapcat.model import ENTITIES
from snapcat.operators import checks, ledger, merge, quality
from snapcat.operators.dedupe import dedupe_first_seen
from snapcat.plans import bronze, silver
from snapcat.sources import driver_tables
from snapcat.sources import raw as R
from snapcat.sources import tables as T
from snapcat.streaming.landing import BATCH, incremental_landing

D1, D2 = day("2024-01-31"), day("2024-02-29")


def test_rerun_replaces_its_own_partition_only(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("a", D1), ("b", D1), ("c", D2)], "id string, snapshot_date date")
    T.write_snapshot(both, path)
    T.write_snapshot(spark.createDataFrame([("x", D2)], "id string, snapshot_date date"), path, gather=False)
    read = T.scan_snapshot(spark, path)
    assert dict(read.dtypes)["snapshot_date"] == "date"
    assert records(read, "id") == [
        {"id": "a", "snapshot_date": D1}, {"id": "b", "snapshot_date": D1}, {"id": "x", "snapshot_date": D2}]
    one = T.scan_snapshot(spark, path, "2024-02-29")
    assert [r["id"] for r in records(one)] == ["x"]
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().toString()
    assert [r["id"] for r in records(T.latest_snapshot_filter(read))] == ["x"]


def test_files_stay_bounded(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(1000).withColumn("snapshot_date", F.lit(D1))
    T.write_snapshot(df, str(path), max_records_per_file=300)
    assert len(list(path.glob("snapshot_date=*/*.parquet"))) == 4


def test_quarantine_rerun_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = spark.createDataFrame([("a",), ("b",)], "track_id string")  # no snapshot column
    other = quality.quarantine(rows.limit(1), "another", "r", "2024-01-31")
    T.write_quarantine(other, path)
    for _ in range(2):
        T.write_quarantine(quality.quarantine(rows, "rule", "r", "2024-01-31"), path)
    found = records(spark.read.parquet(path), "dq_rule", "track_id")
    assert [(r["dq_rule"], r["track_id"], str(r["snapshot_date"])) for r in found] == [
        ("another", "a", "2024-01-31"), ("rule", "a", "2024-01-31"), ("rule", "b", "2024-01-31")]
    T.clear_quarantine(spark, path, "2024-01-31", "rule")
    assert [r["dq_rule"] for r in records(spark.read.parquet(path))] == ["another"]
    T.clear_quarantine(spark, f"{path}-never-written", "2024-01-31", "rule")


def write_json(path, documents):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(documents, indent=2))


def artist(i, name="N", snapshot="2024-01-31", **more):
    return {"artist_id": i, "artist_name": name, "extracted_at": "2024-01-31T10:00:00+00:00",
            "snapshot_date": snapshot, **more}


def test_raw_array_files(spark, tmp_path):
    write_json(tmp_path / "artists" / "artists_2024-01-31.json", [artist("a"), artist("b", vendor_uri="v:b")])
    df = R.scan_raw_json(spark, str(tmp_path), "artists", "2024-01-31", field_aliases={"vendor_uri": "external_uri"})
    assert [(r["artist_id"], r["external_uri"]) for r in records(df, "artist_id")] == [("a", None), ("b", "v:b")]
    with pytest.raises(ValueError):
        R.scan_raw_json(spark, str(tmp_path), "labels", "2024-01-31")
    with pytest.raises(AnalysisException):
        R.scan_raw_json(spark, str(tmp_path), "albums", "2024-01-31")


def test_malformed_records_are_split_off_whole(spark, tmp_path):
    folder = tmp_path / "albums"
    folder.mkdir()
    lines = [
        json.dumps({"album_id": "a", "album_name": "n", "total_tracks": 3}),
        '{"album_id": "b", "album_name": ',
        json.dumps({"album_id": "c", "album_name": "n", "total_tracks": "three"}),
    ]
    (folder / "albums_2024-01-31.json").write_text("\n".join(lines))
    scanned = R.scan_raw_json(spark, str(tmp_path), "albums", "2024-01-31", multi_line=False, keep_corrupt=True)
    good, bad = R.corrupt_record_split(scanned)
    assert [r["album_id"] for r in records(good)] == ["a"]
    assert {r[R.CORRUPT] for r in records(bad)} == set(lines[1:])


def test_array_files_round_trip(spark, tmp_path):
    raw = driver_tables.raw_entity(spark, "/root/testdata/sf0.001", "artists", ("2001-12-31",))
    path = R.landing_path(str(tmp_path), "artists", "2001-12-31")
    R.write_raw_arrays(raw, path, rows_per_file=40)
    back = R.scan_raw_json(spark, str(tmp_path), "artists", "2001-12-31")
    assert checks.row_differences(raw, back).isEmpty() and back.count() > 80


def bronze_tables(spark, root, orphan_albums, good_albums, tracks_per_album=1):
    at = "2024-01-31T10:00:00+00:00"
    albums = [(f"al{i}", "n", "album", "2020", "year", 1, "a1", "A", None, None, at, "2024-01-31")
              for i in range(good_albums)]
    albums += [(f"or{i}", "n", "album", "2020", "year", 1, "gone", "A", None, None, at, "2024-01-31")
               for i in range(orphan_albums)]
    tracks = [(f"t{a[0]}-{k}", "n", 1000, True, 1, 1, a[0], "a1", None, at, "2024-01-31")
              for a in albums for k in range(tracks_per_album)]
    rows = {"artists": [("a1", "A", None, None, [], at, "2024-01-31")], "albums": albums, "tracks": tracks}
    for entity in ENTITIES:
        raw = spark.createDataFrame(rows[entity], R.raw_schema(entity))
        T.write_snapshot(bronze.to_bronze(entity, raw), f"{root}/bronze/{entity}")


def gated(spark, root, **more):
    return silver.silver_gated_run(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", f"{root}/report", "2024-01-31", **more
    )


def test_gate_passes(spark, tmp_path):
    bronze_tables(spark, tmp_path, 0, 3)
    result = gated(spark, tmp_path)
    assert result["overall_status"] == "PASS" and result["counts"] == {"artists": 1, "albums": 3, "tracks": 3}
    assert not (tmp_path / "quarantine").exists()
    assert spark.read.parquet(f"{tmp_path}/report/results").count() == 13


@pytest.mark.parametrize("cascade,tracks", [(False, 40), (True, 39)])
def test_gate_warns_and_quarantines(spark, tmp_path, cascade, tracks):
    bronze_tables(spark, tmp_path, 1, 39)
    result = gated(spark, tmp_path, cascade=cascade)
    assert result["overall_status"] == "WARN"
    assert result["counts"] == {"artists": 1, "albums": 39, "tracks": tracks}
    rejected = records(spark.read.parquet(f"{tmp_path}/quarantine/albums"))
    assert [(r["album_id"], r["dq_reason"]) for r in rejected] == [("or0", "orphan_artist_id")]
    assert (tmp_path / "quarantine" / "tracks").exists() == cascade


def test_gate_failure_writes_no_silver(spark, tmp_path):
    bronze_tables(spark, tmp_path, 5, 5)
    with pytest.raises(silver.GateFailed) as failed:
        gated(spark, tmp_path)
    assert any("artist_id->artists" in f for f in failed.value.failures)
    assert not (tmp_path / "silver").exists()
    summary = records(spark.read.parquet(f"{tmp_path}/report/summary"))
    assert [(r["overall_status"], r["total_checks"]) for r in summary] == [("FAIL", 13)]


def test_merge(spark):
    schema = "id string, v string, snapshot_date date"
    prior = spark.createDataFrame([("a", "old", D1), ("b", "old", D1)], schema)
    delta = spark.createDataFrame([("b", "new", D2), ("c", "new", D2)], schema)
    keep = merge.incremental_merge(prior, delta, "id", "2024-03-31")
    assert [(r["id"], r["v"], str(r["snapshot_date"])) for r in records(keep, "id")] == [
        ("a", "old", "2024-03-31"), ("b", "old", "2024-03-31"), ("c", "new", "2024-03-31")]
    replace = merge.incremental_merge(prior, delta, "id", "2024-03-31", delta_wins=True)
    assert [(r["id"], r["v"]) for r in records(replace, "id")] == [("a", "old"), ("b", "new"), ("c", "new")]
    first_ever = merge.incremental_merge(prior.limit(0), delta, "id", "2024-03-31")
    assert [r["id"] for r in records(first_ever, "id")] == ["b", "c"]


def test_first_seen(spark):
    pages = spark.createDataFrame([(2, "a", "late"), (1, "a", "early"), (3, None, "x"), (4, "b", "y")],
                                  "pos int, id string, v string")
    assert [(r["id"], r["v"]) for r in records(dedupe_first_seen(pages, "id", "pos"), "id")] == [
        ("a", "early"), ("b", "y")]


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    table = spark.createDataFrame([(D1,), (D2,)], "snapshot_date date")

    def pending(job):
        entries = ledger.ledger_entries(spark, path)
        return [str(r["snapshot_date"]) for r in ledger.pending_snapshots(table, entries, job).collect()]

    assert pending("j") == ["2024-01-31", "2024-02-29"]
    assert ledger.last_processed(spark, path, "j") == "1970-01-01"
    assert ledger.commit_snapshot(spark, path, "j", "2024-02-29")
    assert not ledger.commit_snapshot(spark, path, "j", "2024-02-29")
    assert ledger.commit_snapshot(spark, path, "j", "2024-01-31")
    # An older backfill does not move the position back.
    assert ledger.last_processed(spark, path, "j") == "2024-02-29"
    assert pending("j") == [] and pending("other") == ["2024-01-31", "2024-02-29"]
    assert ledger.is_processed(spark, path, "j", "2024-01-31")
    ledger.commit_snapshot(spark, path, "other", "2024-01-31")
    ledger.reset_ledger(spark, path, "j")
    assert pending("j") == ["2024-01-31", "2024-02-29"] and pending("other") == ["2024-02-29"]
    assert ledger.commit_snapshot(spark, path, "j", "2024-01-31", metadata="again")
    assert pending("j") == ["2024-02-29"]
    ledger.reset_ledger(spark, path)
    assert pending("j") == pending("other") == ["2024-01-31", "2024-02-29"]


def test_idempotence_verdict(spark):
    schema = "artist_key string, v int, snapshot_date date"
    before = spark.createDataFrame([("a", 1, D1), ("b", 2, D1)], schema)
    parent = spark.createDataFrame([("a",), ("b",)], "artist_key string")
    keys = ["artist_key", "snapshot_date"]
    assert checks.verify_idempotent(before, before, parent, keys, "artist_key").first().idempotent
    after = spark.createDataFrame([("a", 1, D1), ("a", 1, D1), ("c", 2, D1)], schema)
    row = checks.verify_idempotent(before, after, parent, keys, "artist_key").first()
    assert (row.rows_before, row.rows_after, row.duplicate_keys, row.orphans, row.differing_rows, row.idempotent) == (
        2, 3, 1, 1, 3, False)


def test_landing_is_exactly_once(spark, tmp_path):
    landing, table, checkpoint = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "checkpoint")

    def run():
        incremental_landing(spark, f"{landing}/*.json", "artists", table, checkpoint).awaitTermination()
        return sorted((r.artist_id, str(r.snapshot_date)) for r in spark.read.parquet(table).collect())

    write_json(landing / "artists_2024-02-29.json", [artist(" a ", snapshot="2024-02-29")])
    assert run() == [("a", "2024-02-29")]
    # A late snapshot, and another file of one that has already landed.
    write_json(landing / "artists_2024-01-31.json", [artist("b")])
    write_json(landing / "artists_2024-02-29_more.json", [artist("c", snapshot="2024-02-29")])
    expected = [("a", "2024-02-29"), ("b", "2024-01-31"), ("c", "2024-02-29")]
    assert run() == expected
    assert run() == expected
    assert {r[BATCH] for r in spark.read.parquet(table).select(BATCH).collect()} == {0, 1}


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    """A batch that was written but not committed runs again after a restart."""
    landing, table = tmp_path / "raw", str(tmp_path / "bronze")
    write_json(landing / "artists_2024-01-31.json", [artist("a")])
    for attempt in ("first", "second"):
        # A fresh checkpoint makes Spark replay batch 0.
        incremental_landing(
            spark, f"{landing}/*.json", "artists", table, str(tmp_path / attempt)
        ).awaitTermination()
    assert spark.read.parquet(table).count() == 1
