"""Line dedup with a sharded minimal perfect hash.

A line's key is 128 bits of hash.  Keys found in enough documents are dealt to shards by their hash; every shard
gets a minimal perfect hash (bit levels: a key rests in the first level where it is alone in its place, its number is
the count of ones before it), which indexes plain arrays of fingerprints, counts and largest ids.  Lines meet these
arrays, not the keys' rows: they are dealt to the shards, and a probe is one look-up.  A line that is no key
lands in some place too and is told by the fingerprint.

The number of shards follows from the number of lines.  A shard that far more lines probe than others do (one
line in a third of all documents) is copied, and its probes are dealt to the copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.llm.common import batch, load, mix, row_key, small_batches, stage

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
#: White space stripped at both ends of a line.
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Lines per shard on average; a shard with HOT times as many is copied.
LINES_PER_SHARD = 1 << 16
HOT = 4
#: Places per key in each bit level.
ROOM = 2
#: Stands for a NULL id where ids are compared.
LOWEST = -(1 << 63)

LINES = "id long, rk long, line int, first boolean, a long, b long"


def keys_of(text: str, least_chars: int) -> tuple[list[int], list[bytes]]:
    """Numbers of the lines that count, and their 16-byte keys."""
    numbers, keys = [], []
    for number, line in enumerate(text.encode().split(b"\n")):
        line = line.strip(BLANK).lower()  # bytes: A-Z only
        # A character has at most four bytes.
        if len(line) >= 4 * least_chars or (len(line) >= least_chars and len(line.decode()) >= least_chars):
            numbers.append(number)
            keys.append(xxhash.xxh3_128_digest(line))
    return numbers, keys


def lines_of(documents: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """A row per line that counts: its place, and whether its row of ``documents`` held the key before."""
    small_batches(documents.sparkSession)

    def run(batches):
        schema = pa.schema([("id", pa.int64()), ("rk", pa.int64()), ("line", pa.int32()), ("first", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])
        for rows in batches:
            for i, text in enumerate(rows.column(2)):
                numbers, keys = keys_of(text.as_py() or "", least_chars)
                if not keys:
                    continue
                n, seen = len(keys), set()
                first = [not (k in seen or seen.add(k)) for k in keys]
                words = np.frombuffer(b"".join(keys), np.int64).reshape(n, 2)
                where = pa.array(np.full(n, i))
                yield batch(schema, rows.column(0).take(where), rows.column(1).take(where), numbers, first,
                            np.ascontiguousarray(words[:, 0]), np.ascontiguousarray(words[:, 1]))

    return documents.select(F.col("doc_id").cast("long").alias("id"), row_key("doc_id", "text").alias("rk"), "text").mapInArrow(run, LINES)


def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64))) % np.uint64(size)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit levels for distinct 64-bit keys, and the number of each key (0 to n - 1, no gaps)."""
    levels, number, rest, before = [], np.empty(len(keys), np.int64), np.arange(len(keys)), 0
    while len(rest):
        size = max(64, ROOM * len(rest))
        at = place(keys[rest], len(levels), size)
        bits = np.bincount(at, minlength=size) == 1
        alone = bits[at]
        number[rest[alone]] = before + np.cumsum(bits)[at[alone]] - 1
        levels.append(bits)
        before += int(bits.sum())
        rest = rest[~alone]
    return levels, number


def look_up(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Number of each key; of a stranger some number, or -1."""
    out, rest, before = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        at = place(keys[rest], level, len(bits))
        found = bits[at]
        out[rest[found]] = before + np.cumsum(bits)[at[found]] - 1
        before += int(bits.sum())
        rest = rest[~found]
    return out


INDEX = "shard long, sizes array<long>, bits binary, fingerprints binary, counts binary, largest binary"


def build_shard(key: tuple, rows: pa.Table) -> pa.Table:
    """Perfect hash and arrays of one shard.  Keys with one first half (not to be expected) stand in a later row."""
    a, b, n, largest = (np.asarray(rows[c].combine_chunks()) for c in ("a", "b", "n", "largest"))
    out = []
    while len(a):
        _, once = np.unique(a, return_index=True)
        levels, number = perfect_hash(a[once].view(np.uint64))
        arrays = []
        for values, kind in ((b, np.int64), (np.minimum(n, 0xFFFFFFFF), np.uint32), (largest, np.int64)):
            array = np.empty(len(once), kind)
            array[number] = values[once]
            arrays.append(array.tobytes())
        bits = np.packbits(np.concatenate(levels), bitorder="little").tobytes()
        out.append((key[0].as_py(), [len(x) for x in levels], bits, *arrays))
        later = np.ones(len(a), bool)
        later[once] = False
        a, b, n, largest = a[later], b[later], n[later], largest[later]
    return pa.table(dict(zip(("shard", "sizes", "bits", "fingerprints", "counts", "largest"), map(list, zip(*out)))), schema=pa.schema([
        ("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("fingerprints", pa.binary()), ("counts", pa.binary()), ("largest", pa.binary())]))


def line_index(lines: DataFrame, shards: int, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Sharded index of the keys in at least ``least_documents`` rows: a row per shard that has any."""
    counts = (
        lines.filter("first").groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.coalesce("id", F.lit(LOWEST))).alias("largest"))
        .filter(F.col("n") >= least_documents)
    )
    return counts.withColumn("shard", F.pmod("a", F.lit(shards))).groupBy("shard").applyInArrow(build_shard, INDEX)


HITS = "id long, rk long, line int"


def probe(least_documents: int):
    def run(index: pa.Table, lines: pa.Table) -> pa.Table:
        """Lines of one shard (or of a share of its lines) that go."""
        schema = pa.schema([("id", pa.int64()), ("rk", pa.int64()), ("line", pa.int32())])
        a, b = (np.asarray(lines[c].combine_chunks()) for c in ("a", "b"))
        mine = np.asarray(lines["id"].combine_chunks().fill_null(LOWEST))
        goes = np.zeros(len(a), bool)
        for row in index.to_pylist():
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little", count=sum(row["sizes"])).view(bool)
            number = look_up(np.split(bits, np.cumsum(row["sizes"])[:-1]), a.view(np.uint64))
            fingerprints, counts, largest = (np.frombuffer(row[c], k) for c, k in (("fingerprints", np.int64), ("counts", np.uint32), ("largest", np.int64)))
            key = (number >= 0) & (fingerprints[number] == b)
            goes |= key & (counts[number] >= least_documents) & (largest[number] != mine)
        return lines.select(["id", "rk", "line"]).filter(pa.array(goes)).cast(schema)

    return run


def rebuild(joined: DataFrame) -> DataFrame:
    """(id, text, goes) to (doc_id, n_lines, n_dropped, text)."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])
        for rows in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, goes in zip(rows.column(1), rows.column(2)):
                lines, gone = (text.as_py() or "").split("\n"), set(goes.as_py() or ())
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else "\n".join(lines))
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
            yield batch(schema, rows.column(0), n_lines, n_dropped, texts)

    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, text string")


def dedup_lines(documents: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text of every row.

    A key of at least ``least_chars`` code points in at least ``least_documents`` rows loses its lines, except in the
    rows with the largest doc_id that holds it.  A NULL or empty text is one empty line, which counts nowhere.  A NULL
    doc_id counts as smaller than any other; rows are documents, so repeated rows count each, and all rows under the
    largest id keep the line.  No documents give no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    lines = stage(lines_of(documents, least_chars), "lines")
    shards = max(1, -(-lines.count() // LINES_PER_SHARD))
    lines = lines.withColumn("shard", F.pmod("a", F.lit(shards)))
    index = stage(line_index(lines, shards, least_documents), "line-index")
    # At most a HOT-th of the shards: a few bytes for each several hundred thousand lines.
    hot = stage(
        lines.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(HOT * LINES_PER_SHARD)).alias("copies")).filter("copies > 1"), "hot-shards")
    one = F.lit(1).cast("long")
    probes = lines.join(F.broadcast(hot), "shard", "left").withColumn("copy", F.pmod("rk", F.coalesce("copies", one)))
    times = hot.select(F.col("shard"), F.col("copies").alias("times"))
    arrays = index.join(F.broadcast(times), "shard", "left").withColumn("copy", F.explode(F.sequence(one - 1, F.coalesce("times", one) - 1)))
    hits = arrays.groupBy("shard", "copy").cogroup(probes.groupBy("shard", "copy")).applyInArrow(probe(least_documents), HITS)
    gone = hits.groupBy("id", "rk").agg(F.collect_set("line").alias("goes")).select(F.col("id").alias("hid"), F.col("rk").alias("hrk"), "goes")
    docs = small_batches(spark) and documents.select(F.col("doc_id").cast("long").alias("id"), row_key("doc_id", "text").alias("rk"), "text")
    joined = docs.join(gone, (F.col("rk") == F.col("hrk")) & F.col("id").eqNullSafe(F.col("hid")), "left")
    return rebuild(joined.select("id", "text", "goes"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH l AS (SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
c AS (SELECT k, max(doc_id) AS largest FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
SELECT l.doc_id, count(*) AS n_lines, count(c.k) FILTER (WHERE l.doc_id <> largest) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.k IS NULL OR l.doc_id = largest), '')) AS kept_sha256
FROM l LEFT JOIN c ON l.k = c.k GROUP BY l.doc_id
"""
