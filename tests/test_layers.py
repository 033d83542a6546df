"""Atomic publishing, kept-up dimensions, interval logs, damaged and repeated landings, ranks, bitmaps, fingerprints."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from support import day, records

from snapcat.model import SNAPSHOT
from snapcat.operators import checks, intervals, joins, ranking
from snapcat.plans import dimensions
from snapcat.sources import raw as R
from snapcat.sources import tables as T
from snapcat.sources.layers import CommitConflict, Layer
from snapcat.streaming.landing import BATCH, incremental_landing

ROWS = "id string, v int, snapshot_date date"
D1, D2, D3 = "2024-01-31", "2024-02-29", "2024-03-31"


def rows(spark, *values):
    return spark.createDataFrame([(i, v, day(d)) for i, v, d in values], ROWS)


def content(df):
    return sorted((r["id"], r["v"], str(r[SNAPSHOT])) for r in df.collect())


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


# --- layers


@pytest.fixture
def layer(spark, tmp_path):
    out = Layer(spark, str(tmp_path / "layer"))
    commit = out.begin()
    commit.replace_snapshots("t", rows(spark, ("a", 1, D1), ("b", 2, D2)))
    commit.replace_table("d", spark.createDataFrame([("x", 1)], "id string, n int"))
    assert commit.publish("job", D1) == 1
    return out


def test_nothing_is_seen_before_the_commit(spark, layer):
    """A writer that dies between its writes and its commit leaves the old rows."""
    commit = layer.begin()
    commit.replace_snapshots("t", rows(spark, ("z", 9, D2)))
    commit.replace_table("d", spark.createDataFrame([], "id string, n int"))
    del commit
    again = Layer(spark, layer.root)
    assert content(again.table("t")) == [("a", 1, D1), ("b", 2, D2)] and again.table("d").count() == 1
    assert again.versions() == [1]
    # The orphaned folders go when they are old enough; the live ones stay.
    assert again.expire(older_than_hours=1) == 0
    assert again.expire(older_than_hours=0) == 2
    assert content(again.table("t")) == [("a", 1, D1), ("b", 2, D2)]


def test_a_write_that_fails_changes_nothing(spark, layer):
    broken = rows(spark, ("z", 9, D2)).withColumn("v", F.raise_error("lost").cast("int"))
    commit = layer.begin()
    with pytest.raises(Exception, match="lost"):
        commit.replace_snapshots("t", broken)
    assert content(layer.table("t")) == [("a", 1, D1), ("b", 2, D2)]


def test_tables_change_together(spark, layer):
    commit = layer.begin()
    commit.replace_snapshots("t", rows(spark, ("c", 3, D3)), [D2])
    commit.replace_table("d", spark.createDataFrame([("y", 2), ("z", 3)], "id string, n int"))
    assert commit.publish("job", D3) == 2
    assert content(layer.table("t")) == [("a", 1, D1), ("c", 3, D3)]
    assert content(layer.table("t", version=1)) == [("a", 1, D1), ("b", 2, D2)]
    assert content(layer.table("t", snapshot=D3)) == [("c", 3, D3)] and layer.table("t", snapshot="2020-01-01").count() == 0
    assert [layer.table("d", version=v).count() for v in (1, 2)] == [1, 2]
    assert layer.processed("job") == [D1, D3] and layer.pending("t", "other") == [D1, D3]


def test_of_two_writers_one_wins(spark, layer):
    one, two = layer.begin(), layer.begin()
    one.replace_snapshots("t", rows(spark, ("one", 1, D2)))
    two.replace_snapshots("t", rows(spark, ("two", 2, D2)))
    assert one.publish() == 2
    with pytest.raises(CommitConflict):
        two.publish()
    assert content(layer.table("t")) == [("a", 1, D1), ("one", 1, D2)]


def test_writers_of_other_parts_do_not_disturb_each_other(spark, layer):
    one, two = layer.begin(), layer.begin()
    one.replace_snapshots("t", rows(spark, ("one", 1, D2)))
    two.replace_snapshots("t", rows(spark, ("two", 2, D3)))
    assert (one.publish("one", D2), two.publish("two", D3)) == (2, 3)
    assert content(layer.table("t")) == [("a", 1, D1), ("one", 1, D2), ("two", 2, D3)]
    assert (layer.processed("one"), layer.processed("two")) == ([D2], [D3])


def test_a_version_number_is_taken_once(layer):
    path = layer._manifest_path(2)
    assert layer.files.write_new(path, "first") and not layer.files.write_new(path, "second")
    assert layer.files.read(path) == "first"
    assert [n for n in layer.files.names(f"{layer.root}/_versions") if n.startswith(".") and not n.endswith(".crc")] == []


def test_metadata_comes_from_the_manifest(spark, layer):
    parts = {(r.table_name, str(r[SNAPSHOT])): r for r in layer.parts().collect()}
    assert {k: r.row_count for k, r in parts.items()} == {("t", D1): 1, ("t", D2): 1, ("d", "None"): 1}
    assert "FileScan" not in plan_of(layer.parts())
    folder = layer.manifest()["tables"]["t"]["parts"][D1]["folder"]
    sizes = [os.path.getsize(f"{layer.root}/{folder}/{f}") for f in os.listdir(f"{layer.root}/{folder}") if f.endswith(".parquet")]
    assert (parts["t", D1].bytes, parts["t", D1].file_count) == (sum(sizes), len(sizes))
    assert layer.snapshots("t") == [D1, D2] and layer.snapshots("none") == []


def test_newest_snapshot_and_views_of_one_version(spark, layer):
    newest = layer.latest("t")
    assert content(newest) == [("b", 2, D2)]
    # No other snapshot's folder is listed, and no aggregate looks for the newest.
    assert len(newest.inputFiles()) == 1 and "Aggregate" not in plan_of(newest)
    assert set(layer.register_views()) == {"t", "d"}
    commit = layer.begin()
    commit.replace_snapshots("t", rows(spark, ("c", 3, D3)))
    commit.publish()
    assert spark.sql("SELECT count(*) FROM t").first()[0] == 2  # as of the version that was registered
    layer.register_views("t")
    assert spark.sql("SELECT count(*) FROM t").first()[0] == 3 and content(layer.latest("t")) == [("c", 3, D3)]


def test_empty_and_unknown_tables(spark, layer):
    commit = layer.begin()
    commit.replace_snapshots("t", rows(spark), [D1, D2])
    commit.publish()
    assert layer.table("t").count() == 0 and layer.table("t").columns == ["id", "v", SNAPSHOT]
    with pytest.raises(ValueError, match="no table"):
        layer.table("nope")
    with pytest.raises(ValueError, match="without snapshot_date"):
        layer.begin().replace_snapshots("t", rows(spark, ("a", 1, D1)).withColumn(SNAPSHOT, F.lit(None).cast("date")))


# --- dimensions


STORED = "k string, v int, seen_at date"


def keyed(spark, *values):
    return spark.createDataFrame([(k, v, day(d)) for k, v, d in values], STORED)


def merged(stored, incoming, snapshot, history=None):
    return sorted((r.k, r.v, str(r.seen_at)) for r in dimensions.merge_dimension(stored, incoming, "k", snapshot, history).collect())


def test_newest_snapshot_wins_whenever_it_comes(spark):
    stored = keyed(spark, ("a", 1, D1), ("b", 3, D3), ("c", 2, D2))
    incoming = keyed(spark, ("a", 20, D2), ("b", 20, D2), ("n", 20, D2))
    # The late second snapshot: "b" is held by the third; "c", its own row of an earlier run, has gone and has no other.
    assert merged(stored, incoming, D2, lambda keys: keyed(spark)) == [("a", 20, D2), ("b", 3, D3), ("n", 20, D2)]
    assert merged(stored, incoming, D2, lambda keys: keyed(spark, ("c", 1, D1)).join(keys, "k", "left_semi")) == [
        ("a", 20, D2), ("b", 3, D3), ("c", 1, D1), ("n", 20, D2)]
    assert merged(stored, incoming, D2) == [("a", 20, D2), ("b", 3, D3), ("c", 2, D2), ("n", 20, D2)]
    assert merged(keyed(spark), incoming, D2) == [("a", 20, D2), ("b", 20, D2), ("n", 20, D2)]
    assert merged(stored, keyed(spark), D3) == [("a", 1, D1), ("b", 3, D3), ("c", 2, D2)]


def test_stored_side_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "dim" / "commit=0123abcd")
    stored = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(day(D1)).alias("seen_at"))
    dimensions.write_bucketed(stored.repartition(8, "k"), path, "k", 8)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 8
    spark.sql("DROP TABLE bucketed_0123abcd")  # as in another session
    read = dimensions.read_bucketed(spark, path, stored.schema, "k", 8)
    new = spark.range(10_000, 20_001).select(F.col("id").cast("string").alias("k"), F.lit(2).alias("v"), F.lit(day(D2)).alias("seen_at"))
    out = dimensions.merge_dimension(read, new, "k", D2)
    plan = plan_of(out)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert "FileScan" in plan and "Exchange" not in plan[: plan.index("FileScan")].split("SortMergeJoin")[1]
    assert (out.count(), out.filter("v = 2").count()) == (20_001, 10_001)
    # What is written again is one file per bucket, without a further shuffle.
    again = str(tmp_path / "dim" / "commit=4567abcd")
    dimensions.write_bucketed(out, again, "k", 8)
    assert len([f for f in os.listdir(again) if f.endswith(".parquet")]) == 8


# --- intervals


def as_rows(df):
    return sorted((r.id, r.v, str(r[SNAPSHOT])) for r in df.collect())


def test_log_grows_with_the_delta_only(spark):
    base = rows(spark, *((f"k{i}", i, D1) for i in range(100)))
    log = intervals.opened(base, D1)
    delta = rows(spark, ("k1", 1, D2), ("k2", -2, D2), ("new", 7, D2))
    wins = intervals.changes(log, delta, "id", D2, delta_wins=True)
    assert as_rows(wins) == [("k2", -2, D2), ("new", 7, D2)]  # k1 is as it was
    keeps = intervals.changes(log, delta, "id", D2)
    assert as_rows(keeps) == [("new", 7, D2)]
    ended = intervals.changes(log, delta, "id", D2, removed=rows(spark, ("k9", 0, D2), ("k1", 0, D2)))
    whole = log.unionByName(ended)
    assert intervals.as_of(whole, "id", D1).count() == 100
    now = {r.id for r in intervals.as_of(whole, "id", D2).collect()}
    assert now == {f"k{i}" for i in range(100) if i != 9} | {"new"}
    # A key that went comes back, and a rerun of a merge looks at earlier snapshots only.
    back = intervals.changes(whole, rows(spark, ("k9", 99, D3)), "id", D3)
    assert as_rows(back) == [("k9", 99, D3)]
    assert as_rows(intervals.changes(whole.unionByName(back), rows(spark, ("k9", 99, D3)), "id", D3)) == [("k9", 99, D3)]
    spans = {(r.id, r.v): (str(r[SNAPSHOT]), str(r.valid_to)) for r in intervals.intervals(whole.unionByName(back), "id").filter("id IN ('k9', 'k1')").collect()}
    assert spans == {("k9", 9): (D1, D2), ("k9", 99): (D3, "None"), ("k1", 1): (D1, "None")}


def test_random_merges_equal_copies(spark):
    draw, days = random.Random(4), [f"2024-01-{d:02}" for d in range(1, 8)]
    copies, log = {}, None
    for n, d in enumerate(days):
        delta = {f"k{i}": draw.randint(0, 3) for i in draw.sample(range(12), draw.randint(1, 5))}
        gone = {k for k in draw.sample(sorted(copies[days[n - 1]]), 1)} - set(delta) if n else set()
        copies[d] = {k: v for k, v in (copies[days[n - 1]] if n else {}).items() if k not in gone} | delta
        frame = rows(spark, *((k, v, d) for k, v in delta.items()))
        removed = rows(spark, *((k, 0, d) for k in gone)) if gone else None
        new = intervals.opened(frame, d) if log is None else intervals.changes(log, frame, "id", d, True, removed)
        log = spark.createDataFrame((new if log is None else log.unionByName(new)).collect(), intervals.opened(frame, d).schema)
    want = sorted((k, v, d) for d in days for k, v in copies[d].items())
    assert as_rows(intervals.expanded(log, "id", days)) == want
    assert sorted(x for d in days for x in as_rows(intervals.as_of(log, "id", d))) == want


# --- landing


def test_each_element_of_an_array_is_judged_alone(spark, tmp_path):
    good = [{"artist_id": f"a{i}", "artist_name": 'N, {"artist_id": 1}', "genres": ["x", "y"], "snapshot_date": D1} for i in range(4)]
    text = [json.dumps(g) for g in good]
    bad_kind = json.dumps({"artist_id": "k", "genres": 7})
    folder = tmp_path / "artists" / f"artists_{D1}.json"
    folder.mkdir(parents=True)
    (folder / "whole.json").write_text(f"[{', '.join(text)}]")
    (folder / "broken.json").write_text(f'[{text[0]}, {{"artist_id": "cut, "artist_na, {text[1]},\n{bad_kind}, {text[2]}, {{"artist_id": "end of fi')
    (folder / "kinds.json").write_text(f'[1, "text", null, [2], {text[3]}, {{}}]')
    (folder / "empty.json").write_text("[]")
    (folder / "other_first.json").write_text(f'[{{"unknown": 1, "artist_id": "u"}}, {{"artist_id": "oops, {text[0]}]')
    found = R.array_elements(spark, str(tmp_path), "artists", D1)
    rows_, bad = R.corrupt_array_split(found)
    by_file = {}
    for r in found.filter(F.col(R.CORRUPT).isNull()).collect():
        by_file.setdefault(r.file.rsplit("/", 1)[1], []).append(r.artist_id)
    assert {k: sorted(map(str, v)) for k, v in by_file.items()} == {
        "whole.json": ["a0", "a1", "a2", "a3"], "broken.json": ["a0", "a1", "a2"], "kinds.json": ["None", "a3"], "other_first.json": ["a0", "u"]}
    assert {r.artist_name for r in rows_.filter("artist_id = 'a1'").collect()} == {'N, {"artist_id": 1}'}
    assert rows_.columns == [f.name for f in R.raw_schema("artists").fields]
    quarantined = sorted((r.file.rsplit("/", 1)[1], r.position, r[R.CORRUPT]) for r in bad.collect())
    assert [(f, p) for f, p, _ in quarantined] == [
        ("broken.json", 1), ("broken.json", 3), ("broken.json", 5), ("kinds.json", 0), ("kinds.json", 1), ("kinds.json", 2), ("kinds.json", 3),
        ("other_first.json", 1)]
    assert quarantined[1][2].replace(" ", "") == bad_kind.replace(" ", "")


def test_bronze_quarantines_elements_with_file_and_position(spark, tmp_path):
    from snapcat.model import ENTITIES
    from snapcat.plans import bronze

    roots = [str(tmp_path / n) for n in ("raw", "bronze")]
    for entity in ENTITIES:
        key = f"{entity[:-1]}_id"
        file = tmp_path / "raw" / entity / f"{entity}_{D1}.json"
        file.parent.mkdir(parents=True)
        file.write_text(f'[{{"{key}": "1", "snapshot_date": "{D1}"}}, {{"{key}": "cut, {{"{key}": "3", "snapshot_date": "{D1}"}}]')
    run = lambda: bronze.bronze_snapshot(spark, *roots, D1, quarantine_root=str(tmp_path / "q"))
    assert run() == run() == {e: 2 for e in ENTITIES}
    for entity in ENTITIES:
        kept = spark.read.parquet(f"{roots[1]}/{entity}")
        assert sorted(r[0] for r in kept.select(f"{entity[:-1]}_id").collect()) == ["1", "3"]
        bad = spark.read.parquet(f"{tmp_path}/q/{entity}").collect()
        assert [(r.file.rsplit("/", 1)[1], r.position, r.dq_rule) for r in bad] == [(f"{entity}_{D1}.json", 1, "malformed_json")]
    # A mended file empties the quarantine.
    (tmp_path / "raw" / "artists" / f"artists_{D1}.json").write_text(f'[{{"artist_id": "1", "snapshot_date": "{D1}"}}]')
    assert run()["artists"] == 1 and spark.read.parquet(f"{tmp_path}/q/artists").count() == 0


def test_repeats_land_once_across_files_batches_and_runs(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()

    def put(name, *names):
        (raw / name).write_text(json.dumps([{"artist_id": n, "artist_name": n, "snapshot_date": d} for n, d in names]))

    def run():
        incremental_landing(spark, f"{raw}/*.json", "artists", str(tmp_path / "bronze"), str(tmp_path / "check"),
                            max_files_per_batch=1, repeat_key=("artist_id", SNAPSHOT)).awaitTermination()
        return sorted((r.artist_id or "-", str(r[SNAPSHOT]), r[BATCH]) for r in spark.read.parquet(str(tmp_path / "bronze")).collect())

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    put("1.json", ("a", D2), ("a", D2), ("b", D2))
    put("2.json", ("a", D2), ("c", D2))
    first = run()
    assert [r[:2] for r in first] == [("a", D2), ("b", D2), ("c", D2)]
    put("3.json", ("b", D2), ("a", D1), (None, D1))  # the same id at an older snapshot is another record
    put("4.json", ("a", D1), ("d", D2), (None, D1), (None, D3))
    assert [r[:2] for r in run()] == [("-", D1), ("-", D3), ("a", D1), ("a", D2), ("b", D2), ("c", D2), ("d", D2)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


# --- ranks, bitmaps, fingerprints, sizes


def test_ranks_of_a_million_leading_values(spark):
    df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("x"), F.when(F.col("id") % 10 != 0, F.col("id") % 3).alias("y"))
    df = df.unionByName(df.filter("x < 1000")).unionByName(spark.createDataFrame([(None, None)] * 3, "x long, y long"))
    ranked = ranking.dense_rank_any(df, ["x"], "r")
    assert ranked.count() == df.count()
    top = ranked.filter("r <= 3 OR x IS NULL").select("x", "r").distinct().orderBy("r").collect()
    assert [r.r for r in top[:3]] == [1, 2, 3] and top[0].x > top[1].x > top[2].x and (top[-1].x, top[-1].r) == (None, 1_000_001)
    assert ranked.select("x", "r").distinct().agg(F.corr(F.col("x") * -1.0, F.col("r") * 1.0)).first()[0] > 0.999
    # The one window runs over a row per partition.
    for match in plan_of(ranked).split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in match.split("\n")[1]


def test_ranks_within_groups_and_ties(spark):
    draw = random.Random(1)
    data = [(draw.choice("pqr"), draw.choice([1, 2, 3, None]), draw.choice([1.5, None, 2.5])) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, a int, b double")
    got = {(r.g, r.a, r.b): r.n for r in ranking.dense_rank_any(df, ["a", "b"], "n", ["g"]).collect()}
    order = lambda k: tuple((v is None, -(v or 0)) for v in k[1:])
    for g in "pqr":
        keys = sorted({d for d in data if d[0] == g}, key=order)
        assert [got[k] for k in keys] == list(range(1, len(keys) + 1))
    assert ranking.dense_rank_any(df.limit(0), ["a"], "n").count() == 0


def test_presence_over_many_snapshots(spark):
    days = [day("2020-01-01").fromordinal(day("2020-01-01").toordinal() + i) for i in range(150)]
    draw = random.Random(2)
    seen = {f"a{k}": sorted(draw.sample(days, draw.choice([1, 2, 75, 150]))) for k in range(20)}
    seen["all"] = days
    df = spark.createDataFrame([(a, d) for a, ds in seen.items() for d in ds for _ in range(2)], "artist_id string, snapshot_date date")
    got = {r.artist_id: (r.first_seen, r.last_seen, r.times_seen, r.missing_in) for r in joins.presence_gaps(df).collect()}
    assert got == {a: (ds[0], ds[-1], len(ds), ",".join(str(d) for d in days if d > ds[0] and d not in ds)) for a, ds in seen.items()}
    assert joins.presence_gaps(df.limit(0)).count() == 0


def test_fingerprints_find_what_differs(spark):
    before = spark.range(50_000).select(F.col("id"), (F.col("id") % 7).alias("v"), F.lit(day(D1)).alias(SNAPSHOT))
    changed = before.withColumn("v", F.when(F.col("id") == 77, 99).otherwise(F.col("v"))).filter("id <> 5").unionByName(before.filter("id = 9"))
    found = {(r["id"], r["v"]): r.surplus for r in checks.differing_rows(before, changed).collect()}
    assert found == {(77, 0): -1, (77, 99): 1, (5, 5): -1, (9, 2): 1}
    assert checks.differing_rows(before, before.repartition(3)).count() == 0
    # A NULL snapshot is one too; a row that is there twice is not none.
    null = before.withColumn(SNAPSHOT, F.lit(None).cast("date")).limit(3)
    assert checks.differing_rows(null, null.unionByName(null)).count() == 3
    assert checks.differing_rows(null, null.limit(0)).count() == 3


def test_equal_tables_shuffle_sums_only(spark):
    df = spark.range(300_000).select("id", F.lit("x" * 50).alias("pad"), F.lit(day(D1)).alias(SNAPSHOT))
    prints = checks.fingerprints(df, df.columns, [SNAPSHOT], 64)
    plan = plan_of(prints)
    assert "partial_count" in plan and prints.count() == 64
    spark.sparkContext._jvm.System.gc()
    same = checks.differing_rows(df, df, buckets=64)
    same.collect()
    final = same._jdf.queryExecution().executedPlan().toString()
    assert "Final" in final
    # Rows are met by the list of differing buckets before any of them would be shuffled.
    semi = plan_of(same).index("LeftSemi")
    assert "Exchange hashpartitioning(id" in plan_of(same)[:semi] and "Exchange hashpartitioning(id" not in plan_of(same)[semi:]


def test_footprint_reads_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    T.write_snapshot(rows(spark, *((f"k{i}", i, D1) for i in range(500)), ("z", 1, D2)), path)
    half = str(tmp_path / "half")
    rows(spark, *((f"k{i}", i, D1) for i in range(250))).write.parquet(half)
    df = T.parquet_footprint(spark, {("e", "one"): path, ("e", "two"): half}, "one")
    on_disk = lambda p: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(p) for f in fs if f.endswith(".parquet"))
    got = {r.layer: (r.row_count, r.bytes) for r in df.collect()}
    assert got == {"one": (501, on_disk(path)), "two": (250, on_disk(half))}
    plan = plan_of(df)
    assert "ReadSchema: struct<>" in plan and "content" not in plan.split("FileScan binaryFile")[1].split("\n")[0].split("ReadSchema")[0].replace("binaryFile", "")


def test_months_by_position(spark):
    from snapcat.functions import cleaning as C

    df = spark.createDataFrame([("2023/05/01",), ("2023.12",), ("2023-07",), ("2023",), ("2023-",), ("20",), ("abcdefgh",), (None,)], "t string")
    got = [tuple(r) for r in df.select(
        C.release_year(F.col("t")), C.release_month(F.col("t")), C.known_month(F.col("t")), C.normalize_partial_date(F.col("t")).cast("string")).collect()]
    assert got == [(2023, 5, 5, None), (2023, 12, 12, None), (2023, 7, 7, "2023-07-01"), (2023, 1, None, "2023-01-01"), (2023, 1, None, None),
                   (None, None, None, None), (None, None, None, None), (None, None, None, None)]
    assert records(df.limit(0)) == []
