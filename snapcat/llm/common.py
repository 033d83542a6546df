"""Helpers the operators share: staged tables, text as byte arrays, word hashes, row keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.session import scratch_path

#: Rows of one Arrow batch; texts are cut into pieces of CHUNK_BYTES below that.
BATCH_ROWS = 500
CHUNK_BYTES = 1 << 20
#: Odd multiplier of the polynomial hash modulo 2**64, and its inverse.
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
#: Constants of the 64-bit finaliser.
MIX_1, MIX_2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the rows of an Arrow batch: a batch of long texts must fit a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write under the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_of(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (NULL for a NULL id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def row_key(*columns: str) -> Column:
    """Equal for repeated rows, else different (64 bits; join on the id as well)."""
    return F.xxhash64(*(F.col(c) for c in columns))


def hashed_sample(df: DataFrame, rows: int) -> DataFrame:
    """The rows with the ``rows`` smallest distinct values of column ``h``: only hashes meet in one task, rows stay where they are."""
    least = df.select("h").distinct().orderBy("h").limit(rows).agg(F.max("h").alias("h")).first()["h"]
    return df.filter(F.col("h") <= F.lit(least)) if least is not None else df.limit(0)


def free_name(base: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.string()), "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole texts of about ``limit`` bytes."""
    data, offsets = utf8(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(MIX_1)
    h ^= h >> np.uint64(33)
    h *= np.uint64(MIX_2)
    h ^= h >> np.uint64(33)
    return h


def powers(n: int, base: int = MULTIPLIER) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes of byte ranges of one array, from prefix sums; a range's hash does not depend on its place.

    Long arrays go in windows of CHUNK_BYTES (more only for a range that is longer itself), and the powers that are
    kept are those of one window, so memory does not follow the longest text.
    """

    def __init__(self) -> None:
        self.up, self.down = powers(CHUNK_BYTES), powers(CHUNK_BYTES, INVERSE)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) <= CHUNK_BYTES:
            return self.window(data, starts, ends)
        out = np.empty(len(starts), np.uint64)
        number = starts // CHUNK_BYTES
        order = np.argsort(number, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(number[order])) + 1):
            if len(part):
                lo, hi = int(number[part[0]]) * CHUNK_BYTES, int(ends[part].max())
                out[part] = self.window(data[lo:hi], starts[part] - lo, ends[part] - lo)
        return out

    def window(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        # A start at the end of the window belongs to an empty range.
        up, down = (self.up, self.down) if n < CHUNK_BYTES else (powers(n + 1), powers(n + 1, INVERSE))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts])


def ranges(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``member`` bytes that stay within a text."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, member[:-1]
    starts = np.flatnonzero(member & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, member[1:]
    ends = np.flatnonzero(member & (~after | edge[1:])) + 1
    return starts, ends


def word_bytes() -> np.ndarray:
    """Bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased."""
    out = np.zeros(256, bool)
    out[0x30:0x3A] = out[0x61:0x7B] = out[0x41:0x5B] = out[0x80:] = True
    return out


def lower_bytes() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 32
    return out


class Words:
    """Word hashes of a chunk: hash and text number per word, in order."""

    def __init__(self, member: np.ndarray | None = None) -> None:
        self.member = word_bytes() if member is None else member
        self.lower, self.hasher = lower_bytes(), Hasher()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = ranges(self.member[data], offsets)
        hashes = self.hasher(self.lower[data], starts, ends)
        return hashes, np.searchsorted(offsets, starts, "right") - 1


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words (text borders are the caller's business)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(MULTIPLIER)
        out += hashes[j : j + n]
    return mix(out)


#: Bits of the filter that spares a shuffle what cannot match: a power of two (that divides 2**32), at least BITS_PER_KEY
#: for each key, within these bounds.  The upper one is 32 MB; beyond 16 million keys the filter passes more, and what it passes is
#: told by the join.
FILTER_BITS, MOST_FILTER_BITS, BITS_PER_KEY = 1 << 23, 1 << 28, 16


def filter_slots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = keys.view(np.uint64)
    return (keys % np.uint64(bits)).astype(np.int64), ((keys >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)


def bit_filter(keys: DataFrame) -> bytes:
    """Bits of all 64-bit keys (one column), OR-ed per word before they reach the driver: MOST_FILTER_BITS / 8 bytes at most."""
    key = F.col(keys.columns[0])
    bits = BITS_PER_KEY * keys.count()
    bits = min(max(FILTER_BITS, 1 << max(bits - 1, 0).bit_length()), MOST_FILTER_BITS)
    low = lambda c: F.pmod(c, F.lit(bits).cast("long"))
    # The number divides 2**32, so the signed remainder equals the unsigned one.
    slots = keys.select(F.explode(F.array(low(key), low(F.shiftrightunsigned(key, 32)))).alias("slot"))
    words = slots.groupBy((F.col("slot") / 64).cast("long").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[np.asarray(words["word"])] = np.asarray(words["bits"])
    return out.tobytes()


def filter_member(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )
