"""Silver of rows that stand for several snapshots: the general dedupe's rows, with one deal of the source."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapcat.model import DEALT, SNAPSHOT
from snapcat.operators import dedupe
from snapcat.plans import gold, silver
from snapcat.warehouse import Warehouse


@pytest.fixture(scope="module")
def odd_source(spark, tmp_path_factory):
    """Orders and line items with repeated keys, and with NULL in every column."""
    root = tmp_path_factory.mktemp("odd")

    def day(n):
        return dt.datetime(1998, 1, 1) + dt.timedelta(days=n)

    customer = [(k, f"Customer#{k:09d}", "BUILDING") for k in range(120)]
    orders = [(k % 90, k * 7 % 120, "FOP"[k % 3], day(k * 17 % 1500)) for k in range(140)]
    orders += [(None, 5, "F", day(3)), (11, None, "O", day(4)), (12, 3, None, day(5)), (13, 3, "F", None)]
    lines = [(k % 95, k % 4, k % 40, k % 9, k * 1.37, "RAN"[k % 3], day(k * 29 % 1700)) for k in range(600)]
    lines += [(k, None, k, k, 5.0 + k, "R", day(k)) for k in range(20)] * 2
    lines += [(None, 1, 1, 1, 1.0, "R", day(1)), (3, 1, None, 2, None, "A", day(9)), (4, 2, 1, None, 2.0, None, day(9)), (5, 2, 1, 1, 3.0, "N", None)]
    for name, rows, schema in (
        ("customer", customer, "c_custkey long, c_name string, c_mktsegment string"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"),
        ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_shipdate timestamp"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(root / f"{name}.parquet"))
    return str(root)


@pytest.mark.parametrize("entity", ["albums", "tracks"])
def test_same_rows_as_the_general_dedupe(spark, odd_source, entity):
    w = Warehouse(spark, odd_source)
    general = silver.to_silver(entity, w.bronze(entity)).drop("silver_transformed_at")
    built = w.table(entity).select(*general.columns)
    assert general.count() > 100
    assert general.exceptAll(built).count() == 0 and built.exceptAll(general).count() == 0


@pytest.mark.parametrize("entity", ["albums", "tracks"])
def test_nothing_is_shuffled_after_the_rows_are_multiplied(spark, odd_source, entity):
    plan = Warehouse(spark, odd_source).observed_silver(entity)._jdf.queryExecution().executedPlan().toString()
    keyed = plan.split("Union", 1)[1].split("WindowGroupLimit")[0]  # the second part holds rows without a key
    assert "Window [bit_or" in keyed
    above = keyed.split("Window [bit_or")[0]
    assert "Exchange" not in above and DEALT in keyed.split("Window [bit_or")[1]


def test_a_snapshot_goes_to_the_first_row_that_has_it(spark):
    rows = [("a", 1, "x", 0b011), ("a", 1, "y", 0b111), ("b", 2, "z", 0b101), ("b", 2, "zz", 0), (None, 3, "p", 0b001), (None, 4, "q", 0b011)]
    df = spark.createDataFrame(rows, "id string, __dealt long, text string, __seen long").withColumn(SNAPSHOT, F.lit(None).cast("date"))
    days = ("2024-01-31", "2024-02-29", "2024-03-31")
    found = dedupe.dedupe_observed(df, "id", days, ())
    assert sorted((r["id"] or "", str(r[SNAPSHOT]), r["text"]) for r in found.collect()) == [
        ("", days[0], "p"), ("", days[1], "q"), ("a", days[0], "x"), ("a", days[1], "x"), ("a", days[2], "y"), ("b", days[0], "z"), ("b", days[2], "z")]


@pytest.mark.parametrize("name", ["album", "track"])
def test_dimension_of_the_newest_rows(spark, odd_source, name):
    w = Warehouse(spark, odd_source)
    general = getattr(gold, f"dim_{name}")(silver.to_silver(f"{name}s", w.bronze(f"{name}s"))).drop("gold_transformed_at")
    built = w.dim(name).select(*general.columns)
    assert general.exceptAll(built).count() == 0 and built.exceptAll(general).count() == 0
    plan = w.observed_silver(f"{name}s", newest_only=True)._jdf.queryExecution().executedPlan().toString()
    # Multiplied are only the rows without a key.
    assert "Generate" not in plan.split("Union", 1)[1].split("WindowGroupLimit")[0]
