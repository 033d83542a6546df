"""Checks that compare tables: idempotence and contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapcat.model import SNAPSHOT
from snapcat.operators.joins import orphan_counts


def row_differences(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows whose multiplicity differs, with ``surplus`` = after - before.

    Both directions of EXCEPT ALL in one aggregation, combined on the map side.
    """
    names = list(columns or before.columns)
    signed = before.select(*names, F.lit(-1).alias("sign")).unionByName(
        after.select(*names, F.lit(1).alias("sign"))
    )
    return signed.groupBy(*names).agg(F.sum("sign").alias("surplus")).filter(F.col("surplus") != 0)


#: Fingerprints per snapshot; rows are compared one by one only where these differ.
PRINT_BUCKETS = 4096


def fingerprints(df: DataFrame, columns: Sequence[str], within: Sequence[str] = (), buckets: int = PRINT_BUCKETS) -> DataFrame:
    """Order-free fingerprint of the rows of each (``within``, bucket): their number and two sums of hashes.

    Sums, not XOR, so a row that is there twice shows; sums of 64-bit hashes in 38 digits, so nothing overflows.
    A task sends one row per bucket.
    """
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)
    return df.groupBy(*within, _print_bucket(columns, buckets)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(first.cast("decimal(20,0)")).alias("s1"), F.sum(second.cast("decimal(20,0)")).alias("s2"))


def _print_bucket(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.hash(*columns), F.lit(buckets)).alias("__bucket")


def differing_rows(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None, within: Sequence[str] = (SNAPSHOT,),
                   buckets: int = PRINT_BUCKETS) -> DataFrame:
    """As :func:`row_differences`, for tables that are expected to be equal: only sums are shuffled where they are.

    Buckets whose fingerprints differ are found first; then the rows of those buckets alone are compared.
    """
    names = list(columns or before.columns)
    within = [c for c in within if c in names]
    ours = fingerprints(before, names, within, buckets).select(*within, "__bucket", F.struct("n", "s1", "s2").alias("__before"))
    theirs = fingerprints(after, names, within, buckets).select(*within, "__bucket", F.struct("n", "s1", "s2").alias("__after"))
    # A NULL snapshot is a snapshot here.
    sides = ours.withColumn("__after", F.lit(None).cast(theirs.schema["__after"].dataType)).unionByName(
        theirs.withColumn("__before", F.lit(None).cast(ours.schema["__before"].dataType)))
    differ = sides.groupBy(*within, "__bucket").agg(F.max("__before").alias("b"), F.max("__after").alias("a")).filter(~F.col("a").eqNullSafe(F.col("b")))
    # At most a row per snapshot and bucket.
    wrong = F.broadcast(differ.select(*(F.col(c).alias(f"__w{i}") for i, c in enumerate(within)), F.col("__bucket").alias("__wb")))

    def suspects(df: DataFrame) -> DataFrame:
        match = _print_bucket(names, buckets) == F.col("__wb")
        for i, c in enumerate(within):
            match = match & F.col(c).eqNullSafe(F.col(f"__w{i}"))
        return df.select(*names).join(wrong, match, "left_semi")

    return row_differences(suspects(before), suspects(after), names)


def verify_idempotent(
    before: DataFrame,
    after: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    foreign_key: str,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Per snapshot: rows before/after, duplicate keys, orphans, differing rows, verdict."""
    columns = [c for c in before.columns if c not in ignore]
    by_key = after.groupBy(SNAPSHOT, *(k for k in keys if k != SNAPSHOT)).agg(F.count(F.lit(1)).alias("n"))
    parts = {
        "rows_before": before.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("v")),
        "rows_after": by_key.groupBy(SNAPSHOT).agg(F.sum("n").alias("v")),
        "duplicate_keys": by_key.groupBy(SNAPSHOT).agg(F.count(F.when(F.col("n") > 1, 1)).alias("v")),
        "orphans": orphan_counts(after, parent, foreign_key, within=[SNAPSHOT]).select(
            SNAPSHOT, F.col("orphan_count").alias("v")
        )
        if SNAPSHOT in parent.columns
        else _orphans_by_snapshot(after, parent, foreign_key),
        "differing_rows": differing_rows(before, after, columns).groupBy(SNAPSHOT).agg(
            F.count(F.lit(1)).alias("v")
        ),
    }
    long = reduce(
        DataFrame.unionByName,
        [part.select(SNAPSHOT, F.lit(name).alias("measure"), "v") for name, part in parts.items()],
    )
    wide = long.groupBy(SNAPSHOT).agg(
        *(F.coalesce(F.sum(F.when(F.col("measure") == name, F.col("v"))), F.lit(0)).alias(name) for name in parts)
    )
    verdict = (
        (F.col("rows_before") == F.col("rows_after"))
        & (F.col("duplicate_keys") == 0)
        & (F.col("orphans") == 0)
        & (F.col("differing_rows") == 0)
    )
    return wide.withColumn("idempotent", verdict)


def _orphans_by_snapshot(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    known = parent.select(key).distinct().withColumn("__found", F.lit(1))
    return child.select(SNAPSHOT, key).join(known, key, "left").groupBy(SNAPSHOT).agg(
        F.count(F.when(F.col("__found").isNull(), 1)).alias("v")
    )


def contract_check(tables: Mapping[str, DataFrame], contracts: Mapping[str, tuple[int, Sequence[str]]]) -> DataFrame:
    """One row per table: row count against a minimum, columns against a list.

    A contract is ``(minimum rows, column names)``.
    """
    checks = []
    for name, (minimum, expected) in contracts.items():
        table = tables[name]
        same_columns = set(table.columns) == set(expected)
        checks.append(
            table.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(minimum).cast("bigint").alias("min_expected"),
                F.lit(len(table.columns)).alias("column_count"),
                F.lit(len(expected)).alias("expected_columns"),
                F.when((F.col("row_count") >= minimum) & F.lit(same_columns), "PASS")
                .otherwise("WARN")
                .alias("status"),
            )
        )
    return reduce(DataFrame.unionByName, checks)
