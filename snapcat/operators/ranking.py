"""Dense ranks that do not gather a snapshot, or the whole table, in one task.

``DENSE_RANK() OVER (PARTITION BY snapshot ...)`` sends every row of a snapshot
to one task; without PARTITION BY, every row of the table.  A dense rank depends
only on the *distinct* sort keys, so those are ranked and joined back:

1. distinct sort keys, combined on the map side;
2. rank of the remaining keys inside each value of the leading key;
3. a running sum over the distinct leading values gives each its offset.

Only step 3 sees one group per partition.  Its size is the number of distinct
leading values.  Here those are integer counts or two-decimal scores: ``k``
distinct counts need at least ``k * (k - 1) / 2`` underlying rows, so 10^12 rows
give at most about 1.4 million values, and a score in [0, 100] gives 10,001.
For any other leading key there is :func:`dense_rank_any`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapcat.session import scratch_path


def dense_rank_by(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Adds ``name`` = dense rank by ``order_by``, all descending, NULLs last."""
    parts = list(partition_by)
    keys = df.select(*parts, *order_by).distinct()
    lead, *rest = order_by

    if rest:
        inner = Window.partitionBy(*parts, lead).orderBy(*(F.col(c).desc_nulls_last() for c in rest))
        keys = keys.withColumn("__inner", F.row_number().over(inner))
        sizes = keys.groupBy(*parts, lead).agg(F.count(F.lit(1)).alias("__size"))
    else:
        keys = keys.withColumn("__inner", F.lit(1))
        sizes = keys.select(*parts, lead).withColumn("__size", F.lit(1))

    outer = Window.partitionBy(*parts).orderBy(F.col(lead).desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = sizes.withColumn("__offset", F.sum("__size").over(outer) - F.col("__size")).drop("__size")
    if rest:
        ranks = _null_safe_join(keys, running, [*parts, lead], plain=len(parts))
    else:
        ranks = running.withColumn("__inner", F.lit(1))
    ranks = ranks.withColumn(name, (F.col("__offset") + F.col("__inner")).cast("bigint")).drop("__offset", "__inner")
    return _null_safe_join(df, ranks, [*parts, *order_by], plain=len(parts))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], plain: int = 0) -> DataFrame:
    """Join on ``keys``; the first ``plain`` of them, partition columns, are never NULL.

    Plain equality lets a filter on a partition column reach the scans of both sides.
    """
    renamed = right.select(
        *(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)),
        *(F.col(c) for c in right.columns if c not in keys),
    )
    condition = F.lit(True)
    for i, k in enumerate(keys):
        match = F.col(k) == F.col(f"__k{i}") if i < plain else F.col(k).eqNullSafe(F.col(f"__k{i}"))
        condition = match if i == 0 else condition & match
    return left.join(renamed, condition).drop(*(f"__k{i}" for i in range(len(keys))))


def dense_rank_any(df: DataFrame, order_by: Sequence[str], name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Like :func:`dense_rank_by` for keys with any number of distinct leading values; writes the distinct keys once.

    The distinct keys are range-partitioned and sorted, so a key's place is its place in its partition plus the sizes
    of the partitions before it: one number per partition is all that meets in one task.
    """
    parts = list(partition_by)
    keys = df.select(*parts, *order_by).distinct()
    order = [*(F.col(c).asc_nulls_last() for c in parts), *(F.col(c).desc_nulls_last() for c in order_by)]
    path = scratch_path(df.sparkSession, "rank-keys")
    # The id is the partition's number above 33 bits, the row's number in it below.
    keys.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.parquet(path).withColumn("__run", F.shiftright("__at", 33))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("__run").agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    ranks = placed.join(runs, "__run").withColumn(name, F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).drop("__run", "__at", "__before")
    if parts:
        firsts = ranks.groupBy(*parts).agg((F.min(name) - 1).alias("__first"))
        ranks = _null_safe_join(ranks, firsts, parts).withColumn(name, F.col(name) - F.col("__first")).drop("__first")
    return _null_safe_join(df, ranks, [*parts, *order_by])


def rank_per_snapshot(df: DataFrame, order_by: Sequence[str], name: str, snapshot: str = "snapshot_date") -> DataFrame:
    return dense_rank_by(df, order_by, name, [snapshot])


def rank_global(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    return dense_rank_by(df, order_by, name)
