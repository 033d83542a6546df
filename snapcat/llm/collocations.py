"""Phrase collocations over a prefix-free parse.

A text's words are cut where a window of OVERLAP words has a hash that is a multiple of SPACING; a chunk reaches from one
such window to the end of the next, so neighbours share OVERLAP words.  Equal content gives equal chunks, and the
dictionary of distinct chunks with their frequency stands for all texts.  A phrase of up to OVERLAP + 1 words
lies in exactly one chunk among those that begin before the shared words, so phrases that start within the last
OVERLAP words are counted in the next chunk only (the last chunk of a text counts all).

Phrases grow by a word each round: both shorter phrases inside must be frequent.  A bit filter of the frequent
ones, sized by their number, spares the shuffle most phrases that cannot be; it may let some through,
which the counts reject.  Counts are keyed by the phrase itself, not by a hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapcat.llm.common import CHUNK_BYTES, Hasher, batch, chunks, grams, load, lower_bytes, mix, ranges, small_batches, stage

LONGEST = 5
OVERLAP = LONGEST - 1
#: Words between two cuts on average.
SPACING = 48
LEAST_COUNT = 100
TOP = 2000
#: Characters that end a piece; no phrase reaches across.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
#: Filter bits per frequent phrase, and bounds of the filter (at most 32 MB; beyond that it passes more).
BITS_PER_PHRASE, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28
#: Hash buckets whose phrases are counted together first, those in one row of a task, and the largest sum kept.
BUCKETS, BLOCK, MOST_SUM = 1 << 24, 1 << 16, 60_000
#: Phrases a task sums before it hands them on.
FLUSH = 1 << 20
NO_LANGUAGE = "und"


def member_bytes() -> np.ndarray:
    out = np.ones(256, bool)
    out[np.frombuffer(BREAKS + BLANKS, np.uint8)] = False
    return out


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the given ranges one after another, and their bounds."""
    length = ends - starts
    bounds = np.concatenate([[0], np.cumsum(length)])
    out = np.empty(bounds[-1], data.dtype)
    lo = 0
    while lo < len(starts):  # places take eight bytes for each one moved: some ranges at a time
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + CHUNK_BYTES, "right")) - 1)
        first, last = bounds[lo], bounds[hi]
        out[first:last] = data[np.repeat(starts[lo:hi] - bounds[lo:hi], length[lo:hi]) + np.arange(first, last)]
        lo = hi
    return out, bounds


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ranges as a string column."""
    flat, bounds = gather(data, starts, ends)
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())])


def normalised(data: np.ndarray, offsets: np.ndarray, lower: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words joined by one byte: a line end where a piece ends, else a space.

    Bytes, start and end of every word in them, its text, and whether a piece ends after it.
    """
    starts, ends = ranges(member[data], offsets)
    n = len(starts)
    owner = np.searchsorted(offsets, starts, "right") - 1
    stops = np.zeros(len(data) + 1, np.int64)
    breaks = np.zeros(256, bool)
    breaks[np.frombuffer(BREAKS, np.uint8)] = True
    np.cumsum(breaks[data], out=stops[1:])
    following = np.append(starts[1:], len(data))
    broken = stops[following] > stops[ends]
    flat, bounds = gather(lower[data] if len(data) else data, starts, ends)
    # One byte of room after each word.
    new_starts = bounds[:-1] + np.arange(n)
    new_ends = new_starts + (ends - starts)
    out = np.full(len(flat) + n, 32, np.uint8)
    inner = np.ones(len(out), bool)
    inner[new_ends] = False
    out[inner] = flat
    out[new_ends[broken]] = 10
    return out, new_starts, new_ends, owner, broken


def cuts(hashes: np.ndarray, owner: np.ndarray, spacing: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end word and finality of every chunk."""
    n = len(hashes)
    begins = np.zeros(n + 1, bool)
    edge = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if n else np.zeros(0, np.int64)
    begins[edge] = True
    if n >= overlap:
        window = grams(hashes, overlap) % np.uint64(spacing) == 0
        window &= owner[: n - overlap + 1] == owner[overlap - 1 :]
        begins[: n - overlap + 1] |= window
    first = np.flatnonzero(begins[:n])
    last = np.append(owner[first[1:]] != owner[first[:-1]], True) if len(first) else np.zeros(0, bool)
    text_end = np.append(edge[1:], n)[np.searchsorted(edge, first, "right") - 1] if len(first) else first
    following = np.append(first[1:], n)
    end = np.where(last, text_end, np.minimum(following + overlap, text_end))
    return first, end, last


def chunk_table(documents: DataFrame, spacing: int = SPACING, overlap: int = OVERLAP) -> DataFrame:
    """(lang, chunk, final, freq): the dictionary of the parse."""
    small_batches(documents.sparkSession)

    def run(batches):
        schema = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("final", pa.bool_())])
        lower, member, hasher = lower_bytes(), member_bytes(), Hasher()
        for rows in batches:
            langs = rows.column(0)
            for lo, hi, data, offsets in chunks(rows.column(1)):
                text, starts, ends, owner, broken = normalised(data, offsets, lower, member)
                if not len(starts):
                    continue
                # A piece's end belongs to what a window is recognised by.
                hashes = mix(hasher(text, starts, ends) + broken.astype(np.uint64))
                first, end, last = cuts(hashes, owner, spacing, overlap)
                yield batch(schema, langs.take(pa.array(lo + owner[first])), strings(text, starts[first], ends[end - 1]), last)

    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), "text")
    parsed = texts.mapInArrow(run, "lang string, chunk string, final boolean")
    return parsed.groupBy("lang", "chunk", "final").agg(F.count(F.lit(1)).alias("freq"))


def seeds(langs: pa.Array) -> np.ndarray:
    """A hash per row's language."""
    codes = langs.dictionary_encode()
    table = np.array([xxhash.xxh3_64_intdigest(x or "") for x in codes.dictionary.to_pylist()], np.uint64)
    return table[np.asarray(codes.indices)]


def slots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (keys % np.uint64(bits)).astype(np.int64), ((keys >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)


def phrase_filter(phrases: DataFrame) -> np.ndarray:
    """Bits of (lang, phrase) keys, OR-ed per 64-bit word by Spark before they reach the driver."""
    bits = BITS_PER_PHRASE * phrases.count()
    bits = min(max(LEAST_BITS, 1 << max(bits - 1, 0).bit_length()), MOST_BITS)

    def run(batches):
        schema = pa.schema([("slot", pa.int64())])
        hasher = Hasher()
        for rows in batches:
            for lo, hi, data, offsets in chunks(rows.column(1)):
                keys = mix(hasher(data, offsets[:-1], offsets[1:]) + seeds(rows.column(0).slice(lo, hi - lo)))
                yield batch(schema, np.unique(np.concatenate(slots(keys, bits))))

    words = phrases.select("lang", "phrase").mapInArrow(run, "slot long").groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[np.asarray(words["word"])] = np.asarray(words["bits"])
    return out


def phrase_places(size: int, shorter: np.ndarray | None, overlap: int):
    """A function of a batch of the dictionary: where phrases of ``size`` words stand that a chunk counts.

    Gives (rows of the batch, bytes, starts, ends) of those whose two shorter phrases pass the filter ``shorter``.
    """
    hasher = Hasher()
    words_of = np.ones(256, bool)
    words_of[[10, 32]] = False
    member = None if shorter is None else np.unpackbits(shorter.view(np.uint8), bitorder="little").view(bool)

    def found(rows):
        for lo, hi, data, offsets in chunks(rows.column(1)):
            starts, ends = ranges(words_of[data], offsets)
            owner = np.searchsorted(offsets, starts, "right") - 1
            n = len(starts) - size + 1
            if n <= 0:
                continue
            end = np.append(np.flatnonzero(owner[1:] != owner[:-1]) + 1, len(owner))  # words before the end of each chunk
            chunk_end = np.repeat(end, np.diff(np.append(0, end)))
            final = np.asarray(rows.column(2).slice(lo, hi - lo).to_numpy(zero_copy_only=False))
            at = np.arange(n)
            mine = (owner[:n] == owner[size - 1 :]) & (final[owner[:n]] | (at < chunk_end[:n] - overlap))
            broken = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(data[np.minimum(ends, len(data) - 1)] == 10, out=broken[1:])
            mine &= broken[size - 1 : size - 1 + n] == broken[:n]
            at = at[mine]
            if member is not None and len(at):
                lang = seeds(rows.column(0).slice(lo, hi - lo))[owner[at]]
                ok = np.ones(len(at), bool)
                for k in (0, 1):
                    one, two = slots(mix(hasher(data, starts[at + k], ends[at + k + size - 2]) + lang), len(member))
                    ok &= member[one] & member[two]
                at = at[ok]
            if len(at):
                yield lo + owner[at], data, starts[at], ends[at + size - 1]

    return found


def phrase_keys(rows: pa.RecordBatch, where: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hasher: Hasher) -> np.ndarray:
    """Hash of each phrase with its language."""
    return mix(hasher(data, starts, ends) + seeds(rows.column(0))[where])


def frequent_buckets(dictionary: DataFrame, size: int, shorter: np.ndarray, least: int, overlap: int = OVERLAP) -> np.ndarray:
    """Bits of the hash buckets whose phrases together occur ``least`` times; others hold no frequent phrase.

    Three bytes for each phrase and task are shuffled instead of its text.  BUCKETS is fixed: in a corpus that fills all of
    them the filter passes everything, and the counts decide as before.
    """

    def run(batches):
        schema = pa.schema([("block", pa.int32()), ("low", pa.binary()), ("n", pa.binary())])
        found, hasher = phrase_places(size, shorter, overlap), Hasher()
        sums = np.zeros(BUCKETS, np.uint32)
        for rows in batches:
            freq = np.minimum(np.asarray(rows.column(3)), least).astype(np.uint32)
            for where, data, starts, ends in found(rows):
                bucket, inverse = np.unique(phrase_keys(rows, where, data, starts, ends, hasher) % np.uint64(BUCKETS), return_inverse=True)
                sums[bucket] = np.minimum(sums[bucket] + np.bincount(inverse, freq[where]), least)
        for block in range(BUCKETS // BLOCK):
            part = sums[block * BLOCK : (block + 1) * BLOCK]
            low = np.flatnonzero(part)
            if len(low):
                yield batch(schema, [block], [low.astype(np.uint16).tobytes()], [part[low].astype(np.uint16).tobytes()])

    def add(batches):
        schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for block, low, n in zip(*(c.to_pylist() for c in rows.columns)):
                at = np.frombuffer(low, np.uint16)
                total = sums.setdefault(block, np.zeros(BLOCK, np.uint32))
                total[at] = np.minimum(total[at] + np.frombuffer(n, np.uint16), least)
        for block, total in sums.items():
            yield batch(schema, [block], [np.packbits(total >= least, bitorder="little").tobytes()])

    parts = dictionary.select("lang", "chunk", "final", "freq").mapInArrow(run, "block int, low binary, n binary")
    bits = np.zeros(BUCKETS // 8, np.uint8)
    # BUCKETS / 8 bytes in all.
    for block, packed in parts.repartition("block").mapInArrow(add, "block int, bits binary").collect():
        bits[block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(packed, np.uint8)
    return bits


def count_phrases(dictionary: DataFrame, size: int, shorter: np.ndarray | None, overlap: int = OVERLAP, buckets: np.ndarray | None = None) -> DataFrame:
    """(lang, phrase, f) of phrases of ``size`` words whose two shorter phrases pass ``shorter`` and which pass ``buckets``."""

    def run(batches):
        schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
        found, hasher = phrase_places(size, shorter, overlap), Hasher()
        passing = None if buckets is None else np.unpackbits(buckets, bitorder="little").view(bool)
        held: list[pa.Table] = []

        def flush():
            table = pa.concat_tables(held).combine_chunks().group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")])
            held.clear()
            return table.rename_columns({"f_sum": "f"}).select(["lang", "phrase", "f"]).cast(schema)

        waiting = 0
        for rows in batches:
            for where, data, starts, ends in found(rows):
                if passing is not None:
                    ok = passing[(phrase_keys(rows, where, data, starts, ends, hasher) % np.uint64(BUCKETS)).astype(np.int64)]
                    where, starts, ends = where[ok], starts[ok], ends[ok]
                if not len(where):
                    continue
                at = pa.array(where)
                held.append(pa.table([rows.column(0).take(at).cast(pa.large_string()), strings(data, starts, ends),
                                      rows.column(3).take(at).cast(pa.int64())], names=["lang", "phrase", "f"]))
                waiting += len(where)
                if waiting > FLUSH:
                    yield from flush().to_batches(max_chunksize=50_000)
                    waiting = 0
        if held:
            yield from flush().to_batches(max_chunksize=50_000)

    counted = dictionary.select("lang", "chunk", "final", "freq").mapInArrow(run, "lang string, phrase string, f long")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def last_words(phrase: Column, after: Column) -> Column:
    words = F.split(phrase, " ")
    return F.array_join(F.slice(words, after + 1, F.size(words)), " ")


def scored(candidates: DataFrame, frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Lowest-scoring cut of every candidate; products are decimals of 38 digits, exact for any table of longs here."""
    phrase = F.col("phrase")
    parts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(F.split(phrase, " ")) - 1))).select(
        "*", F.array_join(F.slice(F.split(phrase, " "), F.lit(1), F.col("k")), " ").alias("left_part"), last_words(phrase, F.col("k")).alias("right_part"))
    one = frequent.select("lang", F.col("phrase").alias("left_part"), F.col("f").alias("l"))
    two = frequent.select("lang", F.col("phrase").alias("right_part"), F.col("f").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cut = parts.join(one, ["lang", "left_part"]).join(two, ["lang", "right_part"]).join(totals, "lang").withColumns({
        "above": wide("a") * wide("n"), "below": wide("l") * wide("r")})
    # floor(1000 * above / below) by whole division with remainder: no product passes 38 digits.
    whole = F.expr("above div below").cast("long")
    rest = F.expr("(1000 * cast(above % below as decimal(38,0))) div below").cast("long")
    cut = cut.withColumn("score", whole * 1000 + rest)
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return cut.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def collocations(documents: DataFrame, least_count: int = LEAST_COUNT, top: int = TOP, longest: int = LONGEST, spacing: int = SPACING) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    NULL lang is ``und``; NULL, empty and wordless texts count nothing; repeated rows count each.  A word of any
    length is a word.  No documents, or no phrase that is frequent, give no rows; other columns are ignored.
    """
    overlap = longest - 1
    dictionary = stage(chunk_table(documents, spacing, overlap), "chunks")
    words = stage(count_phrases(dictionary, 1, None, overlap), "words")
    totals = stage(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    levels = [stage(words.filter(F.col("f") >= least_count), "frequent-1")]
    for size in range(2, longest + 1):
        shorter = phrase_filter(levels[-1])
        # Pairs of frequent words are many; longer phrases are few once both pairs inside are frequent.
        buckets = frequent_buckets(dictionary, size, shorter, least_count, overlap) if size == 2 and least_count <= MOST_SUM else None
        levels.append(stage(count_phrases(dictionary, size, shorter, overlap, buckets).filter(F.col("f") >= least_count), f"frequent-{size}"))
    frequent = candidates = None
    for df in levels:
        frequent = df if frequent is None else frequent.unionByName(df)
    for df in levels[1:]:
        candidates = df if candidates is None else candidates.unionByName(df)
    # A phrase inside a longer one has at least its count, so equal counts hold for all lengths between: one word more is enough.
    longer = F.split("phrase", " ")
    inner = candidates.filter(F.size(longer) > 2).select("lang", F.col("f").alias("of_longer"), F.explode(F.array(
        F.array_join(F.slice(longer, F.lit(1), F.size(longer) - 1), " "), F.array_join(F.slice(longer, F.lit(2), F.size(longer) - 1), " "))).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("of_longer").alias("of_longer"))
    alone = candidates.join(covered, ["lang", "phrase"], "left").filter("of_longer IS NULL OR of_longer < f").select("lang", "phrase", F.col("f").alias("a"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = scored(alone, frequent, totals).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(load(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
           FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (SELECT f.*, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
o AS (SELECT DISTINCT c.lang, array_to_string(c.w[i : i + m - 1], ' ') AS phrase, c.f
      FROM (SELECT lang, w, f, k, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k) c),
d AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.lang = c.lang AND o.phrase = c.phrase AND 100 * o.f >= 100 * c.f)),
x AS (SELECT lang, phrase, f AS a, j, array_to_string(w[1 : j], ' ') AS lp, array_to_string(w[j + 1 : k], ' ') AS rp
      FROM (SELECT lang, phrase, f, w, k, unnest(range(1, k)) AS j FROM d)),
s AS (SELECT x.lang, x.phrase, x.a, l.f AS l, r.f AS r, n.n, j,
             CAST((1000 * CAST(x.a AS HUGEINT) * CAST(n.n AS HUGEINT)) // (CAST(l.f AS HUGEINT) * CAST(r.f AS HUGEINT)) AS BIGINT) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = lp JOIN f r ON r.lang = x.lang AND r.phrase = rp JOIN n ON n.lang = x.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS cut FROM s),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b WHERE cut = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM t WHERE rank <= 2000
"""
