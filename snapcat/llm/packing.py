"""Best-fit packing of documents into sequences of bounded length.

Pieces are range-sorted by length and ranked within their length, over all partitions.
Packing goes in bulk-synchronous rounds from the longest length to the shortest: in a
round all pieces of one length meet all open gaps, sorted by size; a sweep gives them the
smallest sufficient gaps, pieces and gaps of equal size being matched by rank, so that no two
claim the same place; the gaps shrink, and the sweep repeats until no gap suffices and new
sequences are opened.  Equal sizes are runs of the sort, so a sweep touches runs, not rows: its state is at most
``capacity`` sizes, whatever the size of the corpus, which is packed as one.  The matched rank intervals are
joined back to the ranked pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapcat.llm.common import batch, chunks, load, small_batches, stage
from snapcat.llm.tokens import Encoder, as_binary, with_end

CAPACITY = 1024
END_ID = 2
#: Ranks of one join key: keeps the keys of a frequent length apart.
RANKS_PER_KEY = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_bounds(n: int, capacity: int) -> list[int]:
    """Bounds of the pieces of a document of ``n`` ids: only the first may be shorter than ``capacity``."""
    first = n % capacity or min(n, capacity)
    return [0, *range(first, n + 1, capacity)] if n else [0]


def token_pieces(documents: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """A row per piece of each document; ``keep_ids`` adds the ids as little-endian 32-bit integers."""
    small_batches(documents.sparkSession)

    def run(batches):
        encoder = Encoder(tokenizer, spaced=True)
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                            ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if keep_ids else []))
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(1)):
                ids, bounds = with_end(*encoder(data, offsets), end_id)
                raw = memoryview(ids.astype("<u4").view(np.uint8))
                doc, piece, start, end = [], [], [], []
                for i in range(hi - lo):
                    at = cut_bounds(int(bounds[i + 1] - bounds[i]), capacity)
                    doc += [lo + i] * (len(at) - 1)
                    piece += range(len(at) - 1)
                    start += at[:-1]
                    end += at[1:]
                first = bounds[np.array(doc) - lo]
                begin, stop = first + np.array(start), first + np.array(end)
                crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(begin.tolist(), stop.tolist())]
                extra = [as_binary(ids.astype("<u4"), np.append(begin, stop[-1:]))] if keep_ids else []
                yield batch(schema, b.column(0).take(pa.array(doc)), piece, start, stop - begin, crc, *extra)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES + ", ids binary" * keep_ids)


def ranked(pieces: DataFrame) -> DataFrame:
    """Pieces in the order of their length, numbered from 0 within each length."""
    order = ["length", "doc_id", "piece"]
    laid = pieces.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id().cast("long"))
    columns = laid.columns

    def run(batches):
        last, count = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            length = np.asarray(b.column(columns.index("length")))
            new = np.ones(len(length), bool)
            new[1:] = length[1:] != length[:-1]
            new[0] = last != length[0]
            position = np.arange(len(length))
            begins = np.maximum.accumulate(np.where(new, position, -1))
            local = np.where(begins >= 0, position - begins, position + count)
            last, count = length[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(local.astype(np.int64))], [*columns, "local"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in laid.schema)
    numbered = stage(laid.mapInArrow(run, f"{schema}, local long"), "pack-ranked")
    # A length lies in neighbouring partitions of the range sort: one counter for each.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = numbered.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("shift"))
    return numbered.join(shift, ["length", "part"]).withColumn("rank", F.col("local") + F.col("shift")).drop(
        "local", "shift", "part")


def sweep(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): ranks of a length go to consecutive sequences."""
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    placed, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        gap = length
        while rank < n:
            while gap < capacity and not gaps[gap]:
                gap += 1
            if gap < capacity:
                first, room = gaps[gap].pop()
                take = min(room, n - rank)
                placed.append((length, rank, rank + take, first, capacity - gap))
                if take < room:
                    gaps[gap].append((first + take, room - take))
                gaps[gap - length].append((first, take))
                rank += take
                gap = min(gap, max(length, gap - length))  # the shrunk gap may suffice again
                continue
            each = capacity // length
            full, rest = divmod(n - rank, each)
            for layer in range(each):
                take = full + (layer < rest)
                if take:
                    placed.append((length, rank, rank + take, opened, layer * length))
                    rank += take
            if full:
                gaps[capacity - each * length].append((opened, full))
            if rest:
                gaps[capacity - rest * length].append((opened + full, 1))
            opened += full + (rest > 0)
    return placed


def pack(documents: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset.

    A NULL text counts as empty and gives one piece with the end id alone.  Repeated rows are packed each;
    a NULL doc_id stays NULL; other columns are ignored; no documents give no pieces.
    """
    pieces = stage(token_pieces(documents, tokenizer, end_id, capacity, keep_ids), "pack-pieces")
    items = ranked(pieces)
    counts = items.groupBy("length").agg(F.count(F.lit(1)).alias("n"))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sweep(dict(zip(pdf["length"], pdf["n"])), capacity)
        return pd.DataFrame(rows, columns=["length", "lo", "hi", "sequence", "offset"])

    # There are at most ``capacity`` counts, each the size of a run of the sort.
    places = counts.groupBy().applyInPandas(place, "length long, lo long, hi long, sequence long, offset long")
    places = places.withColumn("key", F.explode(F.sequence(
        F.floor(F.col("lo") / RANKS_PER_KEY), F.floor((F.col("hi") - 1) / RANKS_PER_KEY))))
    items = items.withColumn("key", F.floor(F.col("rank") / RANKS_PER_KEY))
    out = items.join(places, ["length", "key"]).filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    sequence = F.col("sequence") + F.col("rank") - F.col("lo")
    return out.select(*pieces.columns, sequence.alias("sequence_id"), "offset")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
