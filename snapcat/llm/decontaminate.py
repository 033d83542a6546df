"""Benchmark decontamination by winnowing.

Of every window of WINDOW consecutive K-gram hashes the smallest is kept, so two
texts that share K + WINDOW - 1 = 13 consecutive words share a kept fingerprint.
A fingerprint carries the word hashes around it; after the join of document and
benchmark fingerprints each hit is extended to both sides, and runs of at least
13 equal words count.  Items of fewer than 13 words are one window of all their words
and are looked up by the hash of that many words.

Before the join, document fingerprints pass a bit filter of the benchmark's ones, sized by their
number (32 MB at most); it only spares the shuffle fingerprints that cannot match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapcat.llm.common import (
    Words, batch, bit_filter, chunks, filter_member, filter_slots, free_name, grams, load, mix, row_key, small_batches, stage)

SPAN = 13
K = 7
WINDOW = SPAN - K + 1
REACH = SPAN - K
CONTEXT = K + 2 * REACH
#: A document is contaminated if hits cover at least one word in SHARE.
SHARE = 20

PRINTS = "id long, rk long, n_words long, span int, fp long, pos long, context binary"


def fingerprints(words: np.ndarray, owner: np.ndarray, spans: tuple[int, ...], sizes: np.ndarray,
                 whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(span, hash, word position in the chunk) of the kept fingerprints.

    ``whole`` (benchmark side): texts under 13 words give the hash of all their words;
    otherwise every run of each length in ``spans`` below 13 is hashed.
    """
    n = len(words)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if n >= SPAN:
        kg = grams(words, K)
        inside = np.flatnonzero(owner[: n - SPAN + 1] == owner[SPAN - 1 :])
        if len(inside):
            view = np.lib.stride_tricks.sliding_window_view(kg, WINDOW)[inside]
            at = np.unique(inside + view.argmin(axis=1))
            found.append((np.full(len(at), SPAN), kg[at], at))
    for m in range(1, SPAN) if whole else spans:
        if m >= SPAN or n < m:
            continue
        mg = mix(grams(words, m) + np.uint64(m))
        if whole:
            at = first[sizes == m]
        else:
            at = np.flatnonzero(owner[: n - m + 1] == owner[m - 1 :])
        found.append((np.full(len(at), m), mg[at], at))
    if not found:
        return np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    span, fp, at = (np.concatenate(x) for x in zip(*found))
    return span, fp, at


def contexts(words: np.ndarray, owner: np.ndarray, span: np.ndarray, at: np.ndarray, outside: int) -> np.ndarray:
    """Word hashes from REACH before to the end of CONTEXT; what lies outside the text never matches."""
    where = at[:, None] + np.arange(-REACH, CONTEXT - REACH)
    inside = (where >= 0) & (where < len(words))
    where = np.clip(where, 0, max(len(words) - 1, 0))
    inside &= owner[where] == owner[at][:, None]
    # A short item is compared over its own words only.
    inside &= (span[:, None] == SPAN) | ((np.arange(CONTEXT) >= REACH) & (np.arange(CONTEXT) < REACH + span[:, None]))
    return np.where(inside, words[where], np.uint64(outside))


def print_table(df: DataFrame, key: str, spans: tuple[int, ...], bits: bytes | None) -> DataFrame:
    """A row per text with its word count, and a row per fingerprint (that passes ``bits``)."""
    small_batches(df.sparkSession)
    whole, outside = bits is None, 1 if bits is None else 0

    def run(batches):
        tokens = Words()
        member = None if bits is None else filter_member(bits)
        schema = pa.schema([("id", pa.int64()), ("rk", pa.int64()), ("n_words", pa.int64()), ("span", pa.int32()),
                            ("fp", pa.int64()), ("pos", pa.int64()), ("context", pa.binary())])
        for b in batches:
            ids, rks = b.column(0), b.column(1)
            for lo, hi, data, offsets in chunks(b.column(2)):
                words, owner = tokens(data, offsets)
                sizes = np.bincount(owner, minlength=hi - lo)
                none = pa.nulls(hi - lo)
                yield batch(schema, ids.slice(lo, hi - lo), rks.slice(lo, hi - lo), sizes, none, none, none, none)
                span, fp, at = fingerprints(words, owner, spans, sizes, whole)
                if member is not None and len(fp):
                    one, two = filter_slots(fp, len(member))
                    keep = member[one] & member[two]
                    span, fp, at = span[keep], fp[keep], at[keep]
                if len(fp):
                    first = np.concatenate([[0], np.cumsum(sizes)])
                    text = owner[at]
                    around = contexts(words, owner, span, at, outside)
                    yield batch(schema, ids.take(pa.array(lo + text)), rks.take(pa.array(lo + text)), sizes[text], span,
                                fp.view(np.int64), at - first[text], [x.tobytes() for x in around])

    return df.select(F.col(key).cast("long").alias("id"), row_key(key, "text").alias("rk"), "text").mapInArrow(run, PRINTS)


def extend(joined: DataFrame) -> DataFrame:
    """Runs of equal words around each matching fingerprint: (id, rk, item_id, lo, hi)."""

    def run(batches):
        schema = pa.schema([("id", pa.int64()), ("rk", pa.int64()), ("item_id", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            mine = np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint64).reshape(n, CONTEXT)
            theirs = np.frombuffer(b"".join(b.column(5).to_pylist()), np.uint64).reshape(n, CONTEXT)
            span, pos = np.asarray(b.column(2)), np.asarray(b.column(3))
            same = mine == theirs
            left = np.cumprod(same[:, :REACH][:, ::-1], axis=1).sum(axis=1)
            right = np.cumprod(same[:, REACH:], axis=1).sum(axis=1)
            left = np.where(span == SPAN, left, 0)
            ok = (right >= np.minimum(span, K)) & (left + right >= span)
            take = pa.array(np.flatnonzero(ok))
            yield batch(schema, b.column(0).take(take), b.column(1).take(take), b.column(6).take(take), (pos - left)[ok], (pos + right)[ok])

    return joined.mapInArrow(run, "id long, rk long, item_id long, lo long, hi long")


def hits(documents: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word count per document row, matching word runs with their item)."""
    spark = small_batches(documents.sparkSession)
    items = stage(print_table(benchmark, "item_id", (), None), "bench-prints")
    short = [r[0] for r in items.filter(F.col("span") < SPAN).select("span").distinct().collect()]  # at most 12 lengths
    prints = stage(print_table(documents, "doc_id", tuple(short), bit_filter(items.filter("fp is not null").select("fp"))), "doc-prints")
    ours = prints.filter("fp is not null").select("id", "rk", "span", "fp", "pos", "context")
    theirs = items.filter("fp is not null").select(
        F.col("id").alias("item_id"), "span", "fp", F.col("context").alias("item_context")).distinct()
    joined = ours.join(theirs, ["span", "fp"]).select("id", "rk", "span", "pos", "context", "item_context", "item_id")
    return prints.filter("fp is null").select("id", "rk", "n_words"), stage(extend(joined).distinct(), "bench-hits")


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row: doc_id, rk (row key), n_words, n_hit, n_items, items (sorted ids), contaminated.

    A NULL text has no words; NULL item texts match nothing; a NULL item_id marks words as hit but is
    not listed.  Repeated rows get the same result each; rows with one doc_id and other texts are kept
    apart.  An empty benchmark hits nothing.  Other columns are ignored.
    """
    base, found = hits(documents, benchmark)
    seen = Window.partitionBy("id", "rk").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        found.select("id", "rk", "lo", "hi").distinct()
        .withColumn("until", F.coalesce(F.max("hi").over(seen), F.col("lo")))
        .groupBy("id", "rk")
        .agg(F.sum(F.greatest(F.lit(0).cast("long"), F.col("hi") - F.greatest("lo", "until"))).alias("n_hit"))
    )
    # The list of a document's items is the result itself.
    listed = found.groupBy("id", "rk").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    per = covered.join(listed, (covered["rk"] == listed["rk"]) & covered["id"].eqNullSafe(listed["id"])).select(
        covered["id"].alias("hid"), covered["rk"].alias("hrk"), "n_hit", "items")
    out = base.join(per, (F.col("rk") == F.col("hrk")) & F.col("id").eqNullSafe(F.col("hid")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        F.col("id").alias("doc_id"), "rk", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items").cast("long"), F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that are not contaminated, with all their columns."""
    rk, id_ = free_name("bad_rk", documents), free_name("bad_id", documents)
    bad = decontaminate(documents, benchmark).filter("contaminated").select(F.col("rk").alias(rk), F.col("doc_id").alias(id_)).distinct()
    return documents.join(
        bad, (row_key("doc_id", "text") == F.col(rk)) & F.col("doc_id").cast("long").eqNullSafe(F.col(id_)), "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, p, m, array_to_string(w[p : p + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p
             FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
h AS (SELECT doc_id, p, dw.m, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.m = iw.m),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM h) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""
