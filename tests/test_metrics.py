from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from snapcat.functions import display, metrics


def values(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_cadence_calibration(spark):
    days = [14.0, 15.0, 38.0, 107.0, 114.0, 180.0, 5000.0, 1.0, None]
    got = values(spark, [(d,) for d in days], "d double", F.round(metrics.score_cadence(F.col("d")), 1))
    assert got == [100.0, 99.5, 87.0, 49.6, 45.8, 10.0, 10.0, 100.0, 50.0]


def test_growth_score(spark):
    growth = [None, 0.0, 4.0, 10.0, 99.0, -4.0, -10.0, -80.0]
    got = values(spark, [(g,) for g in growth], "g double", metrics.score_growth(F.col("g")))
    assert got == [50.0, 50.0, 70.0, 100.0, 100.0, 30.0, 0.0, 0.0]


@pytest.mark.parametrize(
    "recent,growth,cadence,expected", [(14, 0.0, 31.0, 80.20), (0, 1.97, 28.0, 44.05), (0, -99.0, 900.0, 2.5)]
)
def test_momentum_worked_rows(spark, recent, growth, cadence, expected):
    expr = metrics.momentum_index(F.col("r"), F.col("g"), F.col("c"))
    assert values(spark, [(recent, growth, cadence)], "r bigint, g double, c double", expr) == [expected]


def test_pillars_add_up(spark):
    rng = random.Random(7)
    rows = [
        (rng.randrange(15), rng.choice([None, rng.uniform(-20, 20)]), rng.choice([None, rng.uniform(1, 300)]))
        for _ in range(500)
    ]
    df = spark.createDataFrame(rows, "r bigint, g double, c double")
    cols = F.col("r"), F.col("g"), F.col("c")
    parts = metrics.momentum_pillars(*cols)
    for row in df.select(metrics.momentum_index(*cols).alias("i"), *(c.alias(n) for n, c in parts.items())).collect():
        assert 0 <= row.volume_score <= 40 and 0 <= row.growth_score <= 35 and 0 <= row.cadence_score <= 25
        assert abs(row.i - row.volume_score - row.growth_score - row.cadence_score) <= 1.0
        assert 0 <= row.i <= 100


def test_growth_is_null_without_predecessor(spark):
    rows = [(10, None), (10, 0), (0, 10), (10, 10), (11, 9)]
    got = values(spark, rows, "c bigint, p bigint", metrics.growth_pct(F.col("c"), F.col("p")))
    assert got == [None, None, -100.0, 0.0, 22.22]


def test_bands_at_their_edges(spark):
    score = [(s,) for s in (75.0, 74.99, 60.0, 45.0, 44.99, None)]
    tier = values(spark, score, "s double", metrics.momentum_tier(F.col("s")))
    assert [t.split()[0] for t in tier] == ["Elite", "High", "High", "Moderate", "Low", "Low"]
    badge = values(spark, [(s,) for s in (75.0, 50.0, 25.0, 24.9, None)], "s double", display.momentum_badge(F.col("s")))
    assert [b.split()[1] for b in badge] == ["Hyper-Paced", "High", "Steady", "Dormant", "Unranked"]
    ratio = values(spark, [(r,) for r in (5.0, 4.99, 2.0, 1.99, None)], "r double", metrics.strategy_by_ratio(F.col("r")))
    assert [r.split()[0] for r in ratio] == ["Single-Dominant", "Balanced", "Balanced", "Album-Focused", "Album-Focused"]
    share = values(spark, [(r,) for r in (80.0, 60.0, 59.9, None)], "r double", metrics.strategy_by_share(F.col("r")))
    assert [s.split()[0] for s in share] == ["Single-Dominant", "Balanced", "Album-Centric", "Album-Centric"]
    active = values(spark, [(n,) for n in (10, 9, 5, 1, 0)], "n bigint", metrics.activity_tier(F.col("n")))
    assert [a.split()[0] for a in active] == ["Hyper-Active", "Active", "Active", "Moderate", "Dormant"]


def test_growth_classes_disagree_on_zero_predecessor(spark):
    df = spark.createDataFrame([(5, 0, None), (5, None, None), (5, 5, 0.0), (4, 5, -20.0)], "c bigint, p bigint, g double")
    rows = df.select(
        metrics.growth_class_by_count(F.col("c"), F.col("p")), metrics.growth_class_by_pct(F.col("g"))
    ).collect()
    assert [(a.split()[1], b.split()[1]) for a, b in rows] == [
        ("Expansion", "Snapshot"), ("Snapshot", "Snapshot"), ("Catalog", "Catalog"), ("Reduction", "Pruning")]


def test_month_names_and_seasons(spark):
    months = [(m,) for m in (1, 5, 7, 9, 11, 12, 13, 0, None)]
    names = values(spark, months, "m int", metrics.month_name(F.col("m")))
    assert names == ["January", "May", "July", "September", "November", "December", None, None, None]
    season = values(spark, months[:6], "m int", metrics.season_archetype(F.col("m")))
    assert [s.split()[0] for s in season] == ["Q1", "Late", "Summer", "Mid-Season", "Q4", "Mid-Season"]


def python_compact(n):
    if abs(n) >= 1_000_000:
        return f"{n / 1_000_000:.1f}M"
    if abs(n) >= 1_000:
        return f"{n / 1_000:.1f}K"
    return str(n)


def test_compact_numbers_round_like_fixed_point_text(spark):
    rng = random.Random(3)
    numbers = [0, 7, 999, 1000, 1150, 1250, 1350, 12_050, 999_950, 1_250_000, -1250]
    numbers += [rng.randrange(5_000_000) for _ in range(3000)]
    got = values(spark, [(n,) for n in numbers], "n bigint", display.compact_number(F.col("n")))
    assert got == [python_compact(n) for n in numbers]
    assert values(spark, [(None,)], "n bigint", display.compact_number(F.col("n"))) == ["—"]
    assert values(spark, [(1.5,)], "n double", display.compact_number(F.col("n"))) == ["1.5"]


def test_percentage_and_duration_text(spark):
    rng = random.Random(5)
    shares = [27.4, 0.25, 100.0] + [round(rng.uniform(-50, 200), 2) for _ in range(2000)]
    got = values(spark, [(s,) for s in shares], "s double", display.percentage_text(F.col("s")))
    assert got == [f"{s:.1f}%" for s in shares]
    assert values(spark, [(0.274,)], "s double", display.percentage_text(F.col("s"), is_ratio=True)) == ["27.4%"]
    ms = [185_000, 0, -4, None, 59_999, 3_600_000, 6_000_000]
    clock = values(spark, [(m,) for m in ms], "m bigint", display.clock_duration(F.col("m")))
    assert clock == ["03:05", "00:00", "00:00", "00:00", "00:59", "60:00", "100:00"]
    grouped = values(spark, [(1234567.0,), (1234.56,), (None,)], "n double", display.grouped_number(F.col("n")))
    assert grouped == ["1,234,567", "1,234.6", "—"]


def test_label_badges(spark):
    tiers = [("Hyper-Active (10+ drops/yr)",), ("Moderate Maintenance",), ("Dormant",), ("",), (None,)]
    got = values(spark, tiers, "t string", display.activity_badge(F.col("t")))
    assert [g[0] for g in got] == ["🔥", "📈", "⏳", "⚪", "⚪"]
    kinds = [("Single-Dominant",), ("Balanced Hybrid",), ("Album-Focused",), (None,)]
    got = values(spark, kinds, "t string", display.strategy_badge(F.col("t")))
    assert got == ["🎵 Single-Dominant", "⚖️ Balanced Hybrid", "💿 Album-Focused", "⚪ Unclassified"]
