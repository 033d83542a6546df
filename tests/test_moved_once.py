"""What a run writes and shuffles: kept-up dimensions, landed lines, Bronze of the gated runs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from support import SF_DIR, day

from snapcat import registry, registry_layers
from snapcat.functions import metrics
from snapcat.operators import joins
from snapcat.plans import dimensions, silver
from snapcat.sources import raw as R
from snapcat.sources import tables as T
from snapcat.sources.layers import Layer
from snapcat.warehouse import open_warehouse

D1, D2, D3 = "2024-01-31", "2024-02-29", "2024-03-31"
ROWS = "k string, v int, snapshot_date date, silver_transformed_at timestamp"
KEPT = dimensions.Dimension("dim_k", "rows", "k", lambda rows: rows.select(
    metrics.surrogate_key(F.col("k")).alias("k_key"), "k", "v", "seen_at", F.current_timestamp().alias("gold_transformed_at")))


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_a_new_snapshot_is_shuffled_once_and_the_stored_side_never(spark, tmp_path, monkeypatch):
    source, gold, written = Layer(spark, str(tmp_path / "silver")), Layer(spark, str(tmp_path / "gold")), []
    write = dimensions.write_bucketed
    monkeypatch.setattr(dimensions, "write_bucketed", lambda df, *rest: (written.append(df), write(df, *rest)))

    def apply(snapshot, *rows):
        commit = source.begin()
        commit.replace_snapshots("rows", spark.createDataFrame([(k, v, day(snapshot), None) for k, v in rows], ROWS), [snapshot])
        commit.publish()
        commit = gold.begin()
        dimensions.apply_snapshot(commit, source, KEPT, snapshot, 4)  # fewer than the session's shuffle partitions
        commit.publish()
        return sorted((r.k, r.v, str(r.seen_at)) for r in gold.table("dim_k").collect())

    assert apply(D1, ("a", 1), ("b", 1), ("c", 1), (None, 1)) == [("a", 1, D1), ("b", 1, D1), ("c", 1, D1)]
    assert apply(D3, ("a", 3), ("b", 3), ("d", 3)) == [("a", 3, D3), ("b", 3, D3), ("c", 1, D1), ("d", 3, D3)]
    assert apply(D2, ("a", 2), ("c", 2)) == [("a", 3, D3), ("b", 3, D3), ("c", 2, D2), ("d", 3, D3)]
    for df in written:
        assert plan_of(df).count("Exchange") == 1
    # Again with fewer rows: "b" falls back, "d" goes.
    assert apply(D3, ("a", 4)) == [("a", 4, D3), ("b", 1, D1), ("c", 2, D2)]


def test_buckets_follow_the_size_of_silver(spark, tmp_path, monkeypatch):
    source, gold = Layer(spark, str(tmp_path / "silver")), Layer(spark, str(tmp_path / "gold"))
    commit = source.begin()
    commit.replace_snapshots("rows", spark.range(1000).select(
        F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(D1).cast("date").alias("snapshot_date"),
        F.lit(None).cast("timestamp").alias("silver_transformed_at")))
    commit.publish()
    size = source.parts("rows").first()["bytes"]
    monkeypatch.setattr(dimensions, "BUCKET_BYTES", size // 10)
    commit = gold.begin()
    dimensions.apply_snapshot(commit, source, KEPT, D1, 4)
    commit.publish()
    assert dimensions.stored_dimension(gold, "dim_k")[1] in (10, 11) and gold.table("dim_k").count() == 1000


def test_landed_lines_are_gzipped_and_measured_as_plain_text(spark, tmp_path):
    df = spark.createDataFrame([("é" * 10, 1), (None, 2), ("b", None)], "a string, b int")
    plain, landed = (R.write_raw_lines(df, str(tmp_path / c), c) for c in ("none", R.LANDED))
    expected = sum(f.stat().st_size for f in (tmp_path / "none").iterdir() if f.name.startswith("part-"))
    read = spark.read.text
    found = T.storage_footprint({("e", "raw"): read(landed), ("e", "silver"): read(plain)}, "raw", line_layers=("raw",))
    assert {(r.entity, r.layer): (r.row_count, r.bytes) for r in found.collect()} == {
        (e, layer): (3, expected) for e in ("e", "TOTAL") for layer in ("raw", "silver")}
    layers = registry._layers(open_warehouse(spark, SF_DIR))
    assert all(f.endswith(".gz") for (_, layer), df in layers.items() if layer == "raw" for f in df.inputFiles())


def test_bronze_of_the_published_run_is_written_where_its_rows_are(spark, monkeypatch):
    w, calls = open_warehouse(spark, SF_DIR), []

    class Written(Exception):
        pass

    def stop(*_, **__):
        raise Written

    monkeypatch.setattr(T, "write_snapshot", lambda df, path, *rest, **named: calls.append(named.get("gather", True)))
    monkeypatch.setattr(T, "scan_snapshot", stop)
    with pytest.raises(Written):
        registry_layers.silver_published_run(w)
    assert calls == [False] * 3


def test_a_late_snapshot_deals_keys_and_only_rows_that_may_win(spark, tmp_path, monkeypatch):
    source, gold, merged = Layer(spark, str(tmp_path / "silver")), Layer(spark, str(tmp_path / "gold")), []
    merge = dimensions.merge_dimension
    monkeypatch.setattr(dimensions, "merge_dimension", lambda stored, incoming, *rest: (merged.append(incoming), merge(stored, incoming, *rest))[1])
    for snapshot, n in ((D1, 10), (D3, 1000), (D2, 1010)):
        commit = source.begin()
        commit.replace_snapshots("rows", spark.range(n).select(
            F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(snapshot).cast("date").alias("snapshot_date"),
            F.lit(None).cast("timestamp").alias("silver_transformed_at")))
        commit.publish()
        commit = gold.begin()
        dimensions.apply_snapshot(commit, source, KEPT, snapshot, 4)
        commit.publish()
    assert 10 <= merged[-1].count() < 20
    assert {(str(r.seen_at), r["count"]) for r in gold.table("dim_k").groupBy("seen_at").count().collect()} == {(D3, 1000), (D2, 10)}


def test_surrogate_keys_are_computed_on_reading(spark, tmp_path):
    source, gold = Layer(spark, str(tmp_path / "silver")), Layer(spark, str(tmp_path / "gold"))
    kept = dimensions.Dimension("dim_k", "rows", "k_id", lambda rows: rows.select(
        metrics.surrogate_key(F.col("k_id")).alias("k_key"), F.col("k_id"), "seen_at", F.current_timestamp().alias("gold_transformed_at")), ("k",))
    for snapshot, keys in ((D1, ("a", "b")), (D2, ("b", "c"))):
        commit = source.begin()
        commit.replace_snapshots("rows", spark.createDataFrame([(k, day(snapshot), None) for k in keys], "k_id string, snapshot_date date, silver_transformed_at timestamp"))
        commit.publish()
        commit = gold.begin()
        dimensions.apply_snapshot(commit, source, kept, snapshot, 4)
        commit.publish()
    table = gold.table("dim_k")
    assert table.columns == ["k_key", "k_id", "seen_at", "gold_transformed_at"]
    assert {r.k_id: r.k_key for r in table.collect()} == {r.k: r.m for r in spark.createDataFrame([("a",), ("b",), ("c",)], "k string").select("k", F.md5("k").alias("m")).collect()}
    assert "k_key" not in dimensions.stored_dimension(gold, "dim_k")[0].columns


def test_adopted_snapshots_are_published_without_a_copy(spark, tmp_path):
    written, layer = str(tmp_path / "written"), Layer(spark, str(tmp_path / "layer"))
    rows = spark.createDataFrame([("a", 1, day(D1), None), ("b", 2, day(D2), None), ("c", 3, day(D3), None)], ROWS)
    T.write_snapshot(rows, written)
    commit = layer.begin()
    assert commit.adopt_snapshots("rows", written, rows.schema, [D1, D2, "2030-01-31"]) == {D1: 1, D2: 1}
    assert not layer.has("rows")
    commit.publish("job", D1)
    commit = layer.begin()  # beside rows of its own
    commit.replace_snapshots("rows", spark.createDataFrame([("z", 9, day(D2), None), ("y", 8, day(D3), None)], ROWS))
    commit.publish()
    seen = lambda df: sorted((r.k, r.v, str(r.snapshot_date)) for r in df.collect())
    assert seen(layer.table("rows")) == [("a", 1, D1), ("y", 8, D3), ("z", 9, D2)]
    assert seen(layer.table("rows", version=1)) == [("a", 1, D1), ("b", 2, D2)] and seen(layer.table("rows", snapshot=D1)) == [("a", 1, D1)]
    assert layer.parts("rows", version=1).filter("bytes > 0 AND file_count > 0").count() == 2
    assert layer.expire(keep=1, older_than_hours=0) == 0 and seen(spark.read.parquet(written)) == [("a", 1, D1), ("b", 2, D2), ("c", 3, D3)]


def test_a_merge_writes_its_changes_once(spark, monkeypatch):
    named, path = [], registry_layers.scratch_path
    monkeypatch.setattr(registry_layers, "scratch_path", lambda spark, name: (named.append(name), path(spark, name))[1])
    assert registry_layers.interval_scan_artists(open_warehouse(spark, SF_DIR)).count() > 0
    assert named == ["log-artists"]


def test_orphans_are_found_by_their_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        child = spark.createDataFrame(
            [("1", "a", day(D1)), ("1", "a", day(D1)), ("2", "b", day(D1)), ("3", "a", day(D2)), ("4", None, day(D1)), ("5", "a", None), ("6", None, None)],
            "id string, fk string, snapshot_date date")
        parent = spark.createDataFrame([("a", day(D1)), ("a", day(D1)), ("b", day(D2)), (None, day(D1))], "pk string, snapshot_date date")
        for within in ([], ["snapshot_date"]):
            got, plain = (f(child, parent, "fk", "pk", within) for f in (joins.orphans_by_keys, joins.orphans_anti))
            assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.columns == plain.columns
            assert plan_of(got).index("getbit") > 0
        many = spark.range(20_000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 100).cast("string").alias("fk"))
        known = spark.range(99).select(F.col("id").cast("string").alias("pk"))
        assert joins.orphans_by_keys(many, known, "fk", "pk").count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orphans_are_routed_by_their_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        child = spark.createDataFrame(
            [("1", "a", day(D1)), ("1", "a", day(D1)), ("2", "b", day(D1)), ("3", "a", day(D2)), ("4", None, day(D1)), ("5", "a", None), ("6", None, None)],
            "id string, fk string, snapshot_date date")
        parent = spark.createDataFrame([("a", day(D1)), ("a", day(D1)), ("b", day(D2)), (None, day(D1))], "pk string, snapshot_date date")
        for within in ([], ["snapshot_date"]):
            plain = [f(child, parent, "fk", "pk", within) for f in (joins.keep_with_parent_semi, joins.orphans_anti)]
            for got, want in zip(joins.split_by_keys(child, parent, "fk", "pk", within), plain, strict=True):
                assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns
        kept, orphans = joins.split_by_keys(child, child.withColumnRenamed("fk", "pk"), "fk", "pk")
        assert (kept.count(), orphans.count()) == (5, 2)  # nothing lacks but NULL
        artists = spark.range(99).select(F.col("id").cast("string").alias("artist_id"), F.lit(D1).cast("date").alias("snapshot_date"))
        albums = spark.range(1000).select(
            F.col("id").cast("string").alias("album_id"), (F.col("id") % 100).cast("string").alias("artist_id"), F.lit(D1).cast("date").alias("snapshot_date"))
        tracks = spark.range(20_000).select(
            F.col("id").cast("string").alias("track_id"), (F.col("id") % 1001).cast("string").alias("album_id"), F.lit(D1).cast("date").alias("snapshot_date"))
        for cascade, gone in ((False, 19), (True, 19 + 200)):
            routed = silver.route_orphans(artists, albums, tracks, cascade)
            assert routed.rejected_albums.count() == 10 and routed.albums.count() == 990
            assert abs(routed.rejected_tracks.count() - gone) <= 1 and routed.tracks.count() + routed.rejected_tracks.count() == 20_000
            assert "getbit" in plan_of(routed.tracks) and "Semi" not in plan_of(routed.tracks)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
