"""Deterministic one-row-per-key operators.

All of them are ``row_number() = 1`` over a key.  Spark turns that into a
WindowGroupLimit that runs before the shuffle too: every map task sends at most
one candidate per key, so a key holding a third of the table moves no more rows
than any other.  The order is made total, so reruns pick the same row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapcat.model import DEALT, SEEN, SNAPSHOT

_RN = "__row_number"
#: Words of 64 bits of the filter of :func:`scd1_by_keys`: a million at most are broadcast, whatever the table.
FILTER_WORDS = 1 << 20


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(field.dataType) for field in dtype.fields)
    return True


def total_order(df: DataFrame, lead: Sequence[Column], lead_names: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """``lead`` followed by every other orderable column as tie-break."""
    used = {*lead_names, *keys}
    rest = [f.name for f in df.schema.fields if f.name not in used and _orderable(f.dataType)]
    return [*lead, *(F.col(name).asc_nulls_last() for name in rest)]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str] = ("extracted_at", "ingestion_timestamp"),
) -> DataFrame:
    """Latest record per key.

    Add the snapshot column to ``keys`` to clean many snapshots in one run;
    without it snapshots collapse into one row per key.
    """
    lead = [F.col(name).desc_nulls_last() for name in recency]
    return first_per_key(df, keys, total_order(df, lead, recency, keys))


def _has(i: int) -> Column:
    return F.col(SEEN).bitwiseAND(F.lit(1 << i)) != 0


def expanded(df: DataFrame, snapshots: Sequence[str]) -> DataFrame:
    """A row per snapshot whose bit in ``SEEN`` is set."""
    seen = F.array(*(F.when(_has(i), F.to_date(F.lit(s))) for i, s in enumerate(snapshots)))
    return df.withColumn(SNAPSHOT, F.explode(F.array_compact(seen))).drop(SEEN, DEALT)


def _first_observed(df: DataFrame, key: str, snapshots: Sequence[str], recency: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, each with the snapshots that no row before it has; deduplicated rows without a key, expanded)."""
    lead = [F.col(name).desc_nulls_last() for name in recency]
    order = total_order(df, lead, recency, [key, SNAPSHOT, SEEN, DEALT])
    before = Window.partitionBy(DEALT, key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.bit_or(SEEN).over(before), F.lit(0).cast("bigint"))
    kept = df.filter(F.col(key).isNotNull() & (F.col(SEEN) != 0)).withColumn("__taken", taken).withColumn(
        SEEN, F.col(SEEN).bitwiseAND(F.bitwise_not("__taken"))).drop("__taken").filter(F.col(SEEN) != 0)
    return kept, dedupe_latest(expanded(df.filter(F.col(key).isNull()), snapshots), [key, SNAPSHOT], recency)


def dedupe_observed(
    df: DataFrame,
    key: str,
    snapshots: Sequence[str],
    recency: Sequence[str] = ("extracted_at", "ingestion_timestamp"),
) -> DataFrame:
    """What :func:`dedupe_latest` per key and snapshot gives for rows that stand for several snapshots.

    ``SEEN`` has a bit per snapshot (oldest first, at most 63); no other column may depend on the snapshot.  All rows
    of a key have one value of ``DEALT``: where that is how the rows are dealt already, nothing is shuffled, and rows
    are sorted before they are multiplied.  A row keeps the snapshots that none before it has.  Rows without a key may
    be dealt anywhere, and are many; they take the general way.
    """
    kept, without = _first_observed(df, key, snapshots, recency)
    return expanded(kept, snapshots).unionByName(without)


def latest_observed(
    df: DataFrame,
    key: str,
    snapshots: Sequence[str],
    recency: Sequence[str] = ("extracted_at", "ingestion_timestamp"),
) -> DataFrame:
    """The newest snapshot's row of each key: :func:`scd1_latest` of :func:`dedupe_observed`, with one row per row of ``df``."""
    kept, without = _first_observed(df, key, snapshots, recency)
    # The bits of a key's rows differ, so the largest number holds the newest snapshot.
    newest = F.max(SEEN).over(Window.partitionBy(DEALT, key))
    day = F.coalesce(*(F.when(_has(i), F.to_date(F.lit(s))) for i, s in reversed([*enumerate(snapshots)])))
    rows = kept.withColumn("__newest", newest).filter(F.col(SEEN) == F.col("__newest")).withColumn(SNAPSHOT, day).drop("__newest", SEEN, DEALT)
    return rows.unionByName(scd1_latest(without, [key], (SNAPSHOT,)))


def scd1_latest(
    df: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str] = (SNAPSHOT, "silver_transformed_at"),
) -> DataFrame:
    """Type-1 dimension rows: the newest snapshot of each natural key wins."""
    return dedupe_latest(df, keys, recency)


def _bit_of(place: Column) -> tuple[Column, Column]:
    return F.pmod(place, F.lit(FILTER_WORDS)), F.shiftrightunsigned(place, 58).cast("int")


def marked(df: DataFrame, keys: DataFrame, place: Column) -> DataFrame:
    """``df`` with ``__hit``, true at least for every row whose ``place`` (a 64-bit hash) a row of ``keys`` has.

    A filter of ``FILTER_WORDS`` words goes to every scan, so no row of ``df`` is shuffled; it may hit other rows too.
    """
    word, bit = _bit_of(place)
    marks = keys.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(
        F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__marks"))
    return df.withColumns({"__word": word, "__bit": bit}).join(F.broadcast(marks), "__word", "left").withColumn(
        "__hit", F.col("__marks").isNotNull() & (F.getbit(F.coalesce("__marks", F.lit(0).cast("bigint")), F.col("__bit")) == 1))


def scd1_by_keys(df: DataFrame, key: str) -> DataFrame:
    """:func:`scd1_latest` per ``key`` for a table that holds most keys in each of its snapshots.

    Only keys are shuffled to find each one's newest snapshot; ``df`` should hold few rows of a key per snapshot, as
    Silver does.  A key that the last snapshot holds once is settled there.  The others, with their newest snapshot, are
    marked in a filter of ``FILTER_WORDS`` words that every scan gets: whole rows are shuffled only where it hits.  It
    errs on the side of more rows; a join with the keys themselves decides.
    """
    known = df.filter(F.col(key).isNotNull())
    at_last = F.col(SNAPSHOT).eqNullSafe(df.agg(F.max(SNAPSHOT)).scalar())
    per_snapshot = known.select(key, SNAPSHOT).repartition(key).groupBy(key, SNAPSHOT).agg(F.count(F.lit(1)).alias("n"))
    per_key = per_snapshot.groupBy(key).agg(F.max(SNAPSHOT).alias(SNAPSHOT), F.max_by("n", SNAPSHOT).alias("n"))
    unsettled = per_key.filter(~(at_last & F.col("n").eqNullSafe(1))).select(key, SNAPSHOT)
    rows = marked(known, unsettled, F.xxhash64(key, SNAPSHOT))
    settled = rows.filter(~F.col("__hit") & at_last).select(*df.columns)
    newest = unsettled.select(key, F.col(SNAPSHOT).alias("__newest"), F.lit(True).alias("__open"))
    hits = rows.filter("__hit").join(newest, key, "left").filter(
        F.when(F.col("__open"), F.col(SNAPSHOT).eqNullSafe(F.col("__newest"))).otherwise(at_last)).select(*df.columns)
    without = df.filter(F.col(key).isNull())
    return settled.unionByName(scd1_latest(hits, [key])).unionByName(scd1_latest(without, [key]))


def dedupe_first_seen(df: DataFrame, key: str, position: str) -> DataFrame:
    """First appearance of each id in page order; rows without an id are dropped."""
    known = df.filter(F.col(key).isNotNull())
    return first_per_key(known, [key], total_order(known, [F.col(position).asc_nulls_last()], [position], [key]))
