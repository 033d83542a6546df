"""Dimensions from all of Silver: the newest row of each key, with only keys shuffled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from support import day

from snapcat.operators import dedupe
from snapcat.plans import gold

D1, D2, D3 = "2024-01-31", "2024-02-29", "2024-03-31"
ROWS = "k string, v int, snapshot_date date, silver_transformed_at timestamp"


def shown(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("words", [1, 2, dedupe.FILTER_WORDS])
def test_same_rows_as_the_general_pick(spark, monkeypatch, words):
    """Keys that leave, come late, repeat or are missing, also where the filter hits nearly everything."""
    monkeypatch.setattr(dedupe, "FILTER_WORDS", words)
    rows = [(f"k{i}", i * 10 + n, day(d), None) for i in range(300) for n, d in enumerate((D1, D2, D3)) if (i + n) % 4]
    rows += [("k5", v, day(D3), None) for v in (1, 2)] + [("old", v, day(D1), None) for v in (7, 3, None)]
    rows += [(None, 4, day(D1), None), (None, 9, day(D2), None), (None, 8, day(D2), None), ("dateless", 5, None, None), ("dateless", 2, None, None), ("k6", 0, None, None)]
    df = spark.createDataFrame(rows, ROWS)
    found = dedupe.scd1_by_keys(df, "k")
    assert found.columns == df.columns
    assert shown(found) == shown(dedupe.scd1_latest(df, ["k"]))
    nothing = df.filter("v > 1000000")
    assert shown(dedupe.scd1_by_keys(nothing, "k")) == []
    dateless = df.withColumn("snapshot_date", F.lit(None).cast("date"))
    assert shown(dedupe.scd1_by_keys(dateless, "k")) == shown(dedupe.scd1_latest(dateless, ["k"]))


def test_rows_of_settled_keys_are_not_shuffled(spark, tmp_path):
    """Track dimension over three snapshots, alike but for one track that leaves: of all rows only key and snapshot are dealt."""
    columns = {"track_id": "string", "album_id": "string", "artist_id": "string", "track_name": "string", "duration_ms": "bigint", "duration_min": "double",
               "duration_sec": "bigint", "explicit": "boolean", "track_number": "int", "disc_number": "int", "external_uri": "string"}
    wide = spark.range(4001).select(*(F.col("id").cast(t).alias(c) for c, t in columns.items()), F.current_timestamp().alias("silver_transformed_at"))
    for d in (D1, D2, D3):
        wide.filter(F.lit(d == D1) | (F.col("track_id") != "17")).write.parquet(str(tmp_path / f"snapshot_date={d}"))
    dimension = gold.dim_track(spark.read.parquet(str(tmp_path)))
    assert dimension.count() == 4001
    moved = sent(dimension)
    assert moved["track_id"] >= 12_001 and 1 <= moved["track_name"] < 20


def sent(df) -> dict[str, int]:
    """Rows shuffled per column, over the exchanges of the executed plan."""
    df.collect()
    found: dict[str, int] = {}

    def walk(node):
        name = node.nodeName()
        if name in ("AdaptiveSparkPlan", "ResultQueryStage"):
            return walk(node.executedPlan() if name == "AdaptiveSparkPlan" else node.plan())
        if name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            rows = node.metrics().apply("shuffleRecordsWritten").value()
            for i in range(node.output().size()):
                column = node.output().apply(i).name()
                found[column] = found.get(column, 0) + rows
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found
