"""Physical plans: what must not be shuffled, scanned or gathered."""

from __future__ import annotations

import re

import pytest
from support import SF_DIR

import __spark_entry__ as driver
from snapcat.registry import registered
from snapcat.warehouse import open_warehouse

LIGHT = [n for n in sorted(registered()) if n.startswith(("mart_", "q1", "q2", "q3", "q4", "q5", "q6", "q7", "q8"))]


def plan_of(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def run(spark, name):
    return registered()[name](spark, SF_DIR)


@pytest.mark.parametrize("name", LIGHT + ["warehouse_health", "quality_gate", "executive_kpis", "profile_snapshot"])
def test_no_cross_joins(spark, name):
    plan = plan_of(run(spark, name))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_top_row_per_key_is_limited_before_the_shuffle(spark):
    plan = plan_of(run(spark, "silver_tracks"))
    final, partial = plan.index("Final"), plan.index("Partial")
    exchange = plan.index("Exchange hashpartitioning(track_id")
    assert final < exchange < partial


def test_unique_tracks_are_counted_without_shuffling_ids(spark):
    # What follows is a listing of the dynamic-pruning filter, not more work.
    plan = plan_of(run(spark, "snapshot_base")).split("SubqueryAdaptiveBroadcast")[0]
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert exchanges and not any("track_id" in e or "album_id" in e for e in exchanges)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert len(scans) == 3
    assert not any("name" in s or "duration" in s for s in scans)


def test_unordered_windows_run_over_distinct_keys_only(spark):
    """A window without PARTITION BY sits on an aggregate, never on the rows."""
    for name in ("q1_top_active", "q4_net_tracks_added", "q7_momentum_leaderboard", "mart_artist_activity_latest"):
        plan = plan_of(run(spark, name))
        for match in re.finditer(r"Exchange SinglePartition", plan):
            below = plan[match.end():].split("\n")[1]
            assert "HashAggregate" in below or "Project" in below, (name, below)


def test_orphan_rates_join_one_row_per_key(spark):
    plan = plan_of(run(spark, "dq_referential"))
    join = plan.index("Join")
    assert "partial_count(1)" in plan[join:]


def test_snapshot_filter_prunes_partitions(spark):
    w = open_warehouse(spark, SF_DIR)
    from snapcat.plans.reads import at_snapshot

    plan = plan_of(at_snapshot(w.table("tracks"), "2001-12-31").select("track_id"))
    assert re.search(r"PartitionFilters: \[isnotnull\(snapshot_date#\d+\), \(snapshot_date#\d+ = 2001-12-31\)\]", plan)
    assert "ReadSchema: struct<track_id:string>" in plan


def test_top_n_keeps_n_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan_of(run(spark, "explore_tracks"))


def test_entry_is_lazy(spark):
    df = driver.entry(spark)
    assert "catalog_momentum_index" in df.columns


@pytest.mark.parametrize("name", ["artist_activity_at", "strategy_distribution"])
def test_every_fact_scan_of_one_snapshot_is_pruned(spark, name):
    plan = plan_of(run(spark, name))
    scans = [line for line in plan.split("\n") if "FileScan" in line and "total_singles" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*snapshot_date#\d+ = ", line) for line in scans)


def test_no_shuffle_on_all_columns(spark):
    from snapcat.sources.driver_tables import raw_entity

    assert "l_extendedprice" not in "".join(re.findall(r"Exchange [^\n]*", plan_of(raw_entity(spark, SF_DIR, "tracks"))))


def test_gate_shuffles_keys_without_counters(spark):
    """Counters of row rules are summed per snapshot in each task; track ids are shuffled alone, for uniqueness."""
    plan = plan_of(run(spark, "quality_gate")).split("SubqueryAdaptiveBroadcast")[0]
    lines = plan.split("\n")
    dealt = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line and "track_id" in line.split("ENSURE")[0]]
    assert len(dealt) == 1
    # What is dealt by track id is a distinct list of keys: its aggregate computes nothing.
    assert "functions=[]" in lines[dealt[0] + 1]
    assert sum("FileScan" in line and "track_id" in line for line in lines) == 2  # counters, keys
