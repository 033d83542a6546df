"""Type-1 dimensions kept up snapshot by snapshot.

A stored dimension is bucketed by its natural key.  Applying a snapshot deals that snapshot's rows into the same
buckets and joins bucket with bucket: the stored side, which grows with the history, is neither shuffled nor
rewritten by key, and what is read of Silver is one snapshot.  Each stored row remembers the snapshot that it
comes from, so an older snapshot that arrives late changes only keys that no newer one holds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapcat.functions.metrics import surrogate_key_text
from snapcat.model import SNAPSHOT
from snapcat.operators.dedupe import marked, scd1_latest
from snapcat.plans import gold
from snapcat.session import scratch_path
from snapcat.sources.layers import COMMIT, WHOLE, Commit, Layer, stored_schema

#: Snapshot a stored row comes from.
SEEN = "seen_at"
#: Bytes of Silver per bucket of a dimension that is built from it; a task sorts a bucket.
BUCKET_BYTES = 16_000_000
STAMP = "gold_transformed_at"


@dataclass(frozen=True)
class Dimension:
    """Name, Silver entity, natural key and attributes (a function of Silver rows).

    ``surrogates`` lists the surrogate keys by the name of what they stand for: hashes of a natural key beside them, which do not
    compress, so they are computed on reading.
    """

    name: str
    entity: str
    key: str
    attributes: Callable[[DataFrame], DataFrame]
    surrogates: tuple[str, ...] = ()

    @property
    def derived(self) -> dict[str, str]:
        return {f"{name}_key": surrogate_key_text(f"{name}_id") for name in self.surrogates}


DIMENSIONS = (
    Dimension("dim_artist", "artists", "artist_id", gold.artist_attributes, ("artist",)),
    Dimension("dim_album", "albums", "album_id", gold.album_attributes, ("album", "artist")),
    Dimension("dim_track", "tracks", "track_id", gold.track_attributes, ("track", "album", "artist")),
)


def candidate_rows(dimension: Dimension, silver: DataFrame, buckets: int | None = None) -> DataFrame:
    """Newest row of every key with its attributes and the snapshot it comes from; rows without a key are none.

    With ``buckets`` the rows are dealt into them by key before the newest is picked, and are not dealt again.
    """
    rows = silver.filter(F.col(dimension.key).isNotNull())
    newest = scd1_latest(rows if buckets is None else rows.repartition(buckets, dimension.key), [dimension.key])
    return dimension.attributes(newest.withColumn(SEEN, F.col(SNAPSHOT)))


def merge_dimension(
    stored: DataFrame, incoming: DataFrame, key: str, snapshot: str, history: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``stored`` after applying all rows of ``snapshot`` (``incoming``, one per key).

    A row replaces one of the same or an earlier snapshot.  When a snapshot is applied again with fewer rows, keys that
    only it had held as the newest fall back to ``history(keys)``, the candidates of those keys from other snapshots,
    or go.  ``buckets`` is the number that both sides are dealt into, if they are.
    """
    day = F.to_date(F.lit(snapshot))
    names = stored.columns
    incoming = incoming.select(*names)
    if history is not None:
        held = stored.filter(F.col(SEEN) == day).select(key)
        # A snapshot that is new here holds nothing yet: its rows are not met a second time.
        lost = None if held.isEmpty() else held.join(incoming.select(key), key, "left_anti")
        if lost is not None and not lost.isEmpty():
            incoming = incoming.unionByName(history(lost).select(*names))
            incoming = incoming if buckets is None else incoming.repartition(buckets, key)
    old, new = stored.select(key, F.struct(*names).alias("old")), incoming.select(key, F.struct(*names).alias("new"))
    both = old.join(new, key, "full")
    wins = F.col("new").isNotNull() & (F.col("old").isNull() | (F.col(f"old.{SEEN}") == day) | (F.col(f"old.{SEEN}") <= F.col(f"new.{SEEN}")))
    kept = F.when(wins, F.col("new")).when((F.col(f"old.{SEEN}") == day) & F.col("new").isNull() & F.lit(history is not None), None).otherwise(F.col("old"))
    return both.select(kept.alias("row")).filter("row IS NOT NULL").select("row.*")


def _catalog_name(folder: str) -> str:
    return f"bucketed_{folder.rsplit(f'{COMMIT}=', 1)[1]}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` dealt by ``key``; a task per bucket writes one file."""
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(_catalog_name(path))


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The rows of a bucketed folder, with the session knowing its buckets."""
    name = _catalog_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def stored_dimension(layer: Layer, name: str) -> tuple[DataFrame, int]:
    """A published dimension as it is stored, and its number of buckets."""
    entry = layer.manifest()["tables"][name]
    properties = entry["properties"]
    path = f"{layer.root}/{entry['parts'][WHOLE]['folder']}"
    schema = stored_schema(T.StructType.fromJson(entry["schema"]), properties.get("derived", {}))
    return read_bucketed(layer.spark, path, schema, properties["key"], properties["buckets"]), properties["buckets"]


def _may_win(rows: DataFrame, stored: DataFrame, key: str, snapshot: str, buckets: int) -> DataFrame:
    """``rows`` of a snapshot less most of those whose key ``stored`` has from a newer one.

    Of a snapshot that arrives late only keys are dealt into the buckets, and what may win is staged; whatever the filter lets
    through in vain loses in the merge.
    """
    newer = stored.filter(F.col(SEEN) > F.to_date(F.lit(snapshot))).select(key)
    if newer.isEmpty():
        return rows
    unheld = rows.filter(F.col(key).isNotNull()).select(key).repartition(buckets, key).join(newer, key, "left_anti")
    path = scratch_path(rows.sparkSession, "late")
    marked(rows, unheld, F.xxhash64(key)).filter("__hit").select(*rows.columns).write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def apply_snapshot(commit: Commit, silver: Layer, dimension: Dimension, snapshot: str, buckets: int) -> int:
    """Add to ``commit`` the dimension with one more snapshot of Silver; its rows.

    ``buckets`` counts only for a dimension that does not exist yet (it is then built from all of Silver): it gets as
    many at least, and one per ``BUCKET_BYTES`` of Silver.
    """
    layer = commit.layer
    if layer.has(dimension.name):
        stored, buckets = stored_dimension(layer, dimension.name)

        def history(keys: DataFrame) -> DataFrame:
            others = silver.table(dimension.entity).filter(F.col(SNAPSHOT) != F.to_date(F.lit(snapshot)))
            return candidate_rows(dimension, others.join(keys, dimension.key, "left_semi"))

        arrived = _may_win(silver.table(dimension.entity, snapshot=snapshot), stored, dimension.key, snapshot, buckets)
        incoming = candidate_rows(dimension, arrived, buckets)
        rows = merge_dimension(stored, incoming, dimension.key, snapshot, history, buckets)
    else:
        parts = silver.manifest()["tables"][dimension.entity]["parts"].values()
        buckets = max(buckets, -(-sum(p["bytes"] for p in parts) // BUCKET_BYTES))
        rows = candidate_rows(dimension, silver.table(dimension.entity), buckets)
    derived = dimension.derived
    whole = candidate_rows(dimension, silver.table(dimension.entity)).drop(STAMP).withColumn(STAMP, F.current_timestamp()).schema
    rows = rows.withColumn(STAMP, F.current_timestamp()).select(*stored_schema(whole, derived).names)
    folder = commit.folder(dimension.name)
    write_bucketed(rows, f"{layer.root}/{folder}", dimension.key, buckets)
    return commit.adopt(dimension.name, folder, whole, key=dimension.key, buckets=buckets, derived=derived)
