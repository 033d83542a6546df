"""Landed files are compressed, and read back whole."""

from __future__ import annotations

import pytest

from snapcat import registry, registry_layers
from snapcat.sources import raw as R
from snapcat.model import raw_schema


def test_arrays_are_gzipped_and_read_back(spark, tmp_path):
    schema = raw_schema("albums")
    rows = [tuple(f"{f.name}{k}" if f.dataType.simpleString() == "string" else k for f in schema.fields) for k in range(100)]
    df = spark.createDataFrame(rows, schema)
    path = R.write_raw_arrays(df, R.landing_path(str(tmp_path), "albums", "2024-01-31"), rows_per_file=30)
    files = [f for f in (tmp_path / "albums" / "albums_2024-01-31.json").iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".gz") for f in files)
    assert spark.read.schema(schema).option("multiLine", True).json(path).exceptAll(df).count() == 0
    good, bad = R.corrupt_array_split(R.array_elements(spark, str(tmp_path), "albums", "2024-01-31"))
    assert good.count() == 100 and bad.count() == 0


def test_folders_landed_in_one_pass_hold_what_single_ones_do(spark, tmp_path):
    rows = [(f"a{k}", f"N{k}", f"2024-0{k % 3 + 1}-31") for k in range(100)]
    df = spark.createDataFrame(rows, "artist_id string, artist_name string, snapshot_date string").repartition(3)
    root = str(tmp_path)
    one, two, three, none = (f"{root}/raw/{n}.json" for n in ("one", "two", "three", "none"))
    R.write_raw_folders(df, "snapshot_date", {"2024-01-31": {one: 1, two: 2}, "2024-02-31": {three: 1}, "2030-01-31": {none: 1}}, rows_per_file=20)
    read = lambda path: sorted(r[0] for r in spark.read.schema(df.schema).option("multiLine", True).json(path).collect())
    first, second = (sorted(r[0] for r in rows if r[2] == f"2024-0{k}-31") for k in (1, 2))
    assert read(one) == first and read(two) == sorted(first * 2) and read(three) == second and read(none) == []
    arrays = spark.read.text(two).collect()
    assert max(r.value.count("artist_id") for r in arrays) <= 20 and len(arrays) >= 4
    assert sorted(p.name for p in (tmp_path / "raw").iterdir()) == ["none.json", "one.json", "three.json", "two.json"]


def test_several_snapshots_are_read_once_to_be_landed(spark, monkeypatch):
    """The source is joined once per landing, not once per snapshot."""
    asked = []

    class Stopped(Exception):
        pass

    class Source:
        spark = None

        def raw(self, entity, snapshots):
            asked.append(snapshots)
            raise Stopped

    monkeypatch.setattr(registry_layers, "scratch_path", lambda *_: "/none")
    monkeypatch.setattr(registry, "scratch_path", lambda *_: "/none")
    for run in (registry_layers.corrupt_array_split, registry_layers.landing_with_repeats_tracks, registry.incremental_landing_tracks):
        with pytest.raises(Stopped):
            run(Source())
    assert [len(s) for s in asked] == [5, 3, 3]


def test_pieces_keep_their_text_and_blank_ones_are_none(spark, tmp_path):
    folder = tmp_path / "artists" / "artists_2024-01-31.json"
    folder.mkdir(parents=True)
    good = '{"artist_id": "a", "genres": ["x"]}'
    (folder / "spaced.json").write_text(f' [\n, {good} \n,\t{{"artist_id": "oops \n, {good}, {{"artist_id": 7, "genres": 5}} ] \n')
    (folder / "object.json").write_text(good)
    (folder / "blank.json").write_text(" [ \n ] ")
    elements = R.array_elements(spark, str(tmp_path), "artists", "2024-01-31")
    plan = spark._jvm.PythonSQLUtils.explainString(elements._jdf.queryExecution(), "simple")
    assert plan.count("split(") == 1  # computed once per file
    rows, bad = R.corrupt_array_split(elements)
    assert sorted((r.artist_id, r.genres) for r in rows.collect()) == [("a", ["x"])] * 3
    assert sorted((r.file.rsplit("/", 1)[1], r.position, r[R.CORRUPT]) for r in bad.collect()) == [
        ("blank.json", 0, " \n "), ("spaced.json", 2, '{"artist_id": "oops'), ("spaced.json", 4, '{"artist_id":7,"genres":5}')]
