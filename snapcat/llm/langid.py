"""Language identification with bit-sliced n-gram filters.

Every character trigram that a language uses is entered in a Bloom filter whose slots are
bit masks, one bit per language: the AND of a trigram's slots names all languages that
contain it.  A text's trigrams are counted per language; the count that false positives
alone would give (fill of the language's slice to the power of the number of hashes) is
taken out, and the largest corrected count decides.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.llm.common import bucket_of, free_name, load, mix, small_batches, stage

#: Slots of the filter: a power of two, at least SLOTS_PER_TRIGRAM times the distinct trigrams of the language with the
#: most (a false rate of 0.15 at most), within these bounds.  The upper one is 128 MB for up to 64 languages and
#: holds that rate for four million trigrams of one language; beyond, the rate grows, and counts are corrected by it.
SLOTS, MOST_SLOTS, SLOTS_PER_TRIGRAM = 1 << 20, 1 << 24, 4
HASHES = 2
#: A trigram belongs to each language in which its rate is at least this part of its highest rate.
RATIO = 0.1
#: Texts with a lower score are rejected by ``known_language``.
LEAST_SCORE = 0.25
UNDETERMINED = "und"


class Model(NamedTuple):
    languages: list[str]
    table: np.ndarray  # (slots, words of 64 languages)
    false_rate: np.ndarray  # per language


def letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    unique, where = np.unique(codes, return_inverse=True)
    return np.fromiter((chr(c).isalpha() for c in unique.tolist()), bool, len(unique))[where]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram codes, text number of each, whether a text has a letter).

    Lower-cased letters stay, all else between them is one space; a text begins and ends with a space.
    """
    # Text n begins at the n-th NUL; NULs of the texts themselves become spaces.
    joined = "".join("\0 " + t.lower().replace("\0", " ") + " " for t in texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    border = codes == 0
    small = codes < 128
    letter = np.zeros(len(codes), bool)
    letter[small] = ((codes[small] >= 97) & (codes[small] <= 122))
    if not small.all():
        letter[~small] = letters(codes[~small].astype(np.int64))
    codes[~letter & ~border] = 32
    text = np.cumsum(border) - 1
    has = np.bincount(text[letter], minlength=len(texts))[: len(texts)] > 0
    blank = codes == 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    codes, text = codes[keep], text[keep]
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    inside = (a != 0) & (b != 0) & (c != 0)
    return ((a << np.uint64(42)) | (b << np.uint64(21)) | c)[inside], text[:-2][inside], has


def pieces(texts: list[str], limit: int = 1 << 20):
    """(first, end) of runs of texts of about ``limit`` characters."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def trigram_counts(training: DataFrame) -> DataFrame:
    """(lang, gram, n) over all training texts, pre-aggregated in each task."""

    def run(batches):
        total: dict[str, list] = {}

        def fold(parts):
            grams, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return [(grams, np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64))]

        for b in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for lo, hi in pieces(texts):
                    parts = total.setdefault(lang, [])
                    parts.append(np.unique(trigrams(texts[lo:hi])[0], return_counts=True))
                    if len(parts) > 16:
                        total[lang] = fold(parts)
        for lang, parts in total.items():
            (grams, n), = fold(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    return training.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def slots_of(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    h = mix(grams)
    return [(h % np.uint64(slots)).astype(np.int64), ((h >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)]


def train(training: DataFrame) -> Model:
    """Filters from all rows with a text and a language.

    Only the filter (at most MOST_SLOTS rows per 64 languages) and two numbers per language reach the driver.
    """
    small_batches(training.sparkSession)
    counts = stage(trigram_counts(training.filter("text is not null and lang is not null")), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").cast("double").alias("total"), F.count(F.lit(1)).alias("distinct")).orderBy("lang").collect()
    languages = [r.lang for r in totals]
    words = max(1, -(-len(languages) // 64))
    slots = SLOTS_PER_TRIGRAM * max((r.distinct for r in totals), default=1)
    slots = min(max(SLOTS, 1 << (slots - 1).bit_length()), MOST_SLOTS)
    table = np.zeros((slots, words), np.uint64)
    if languages:
        rate = F.col("n") / F.element_at(F.create_map(*(F.lit(x) for r in totals for x in (r.lang, r.total))), F.col("lang"))
        number = F.element_at(F.create_map(*(F.lit(x) for i, l in enumerate(languages) for x in (l, i))), F.col("lang"))
        rated = counts.select("gram", number.alias("number"), rate.alias("rate")).groupBy("gram").agg(
            F.max("rate").alias("top"), F.collect_list(F.struct("number", "rate")).alias("each"))  # one entry per language
        used = rated.select("gram", F.explode("each").alias("e"), "top").filter(F.col("e.rate") >= RATIO * F.col("top")).select(
            "gram", F.col("e.number").alias("number"))

        def run(batches):
            for b in batches:
                number = np.asarray(b.column(1)).astype(np.int64)
                for slot in slots_of(np.asarray(b.column(0)).view(np.uint64), slots):
                    bits = (np.uint64(1) << (number % 64).astype(np.uint64)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(number // 64), pa.array(bits)], ["slot", "word", "bits"])

        filled = used.mapInArrow(run, "slot long, word long, bits long").groupBy("slot", "word").agg(F.expr("bit_or(bits)").alias("bits"))
        rows = filled.toArrow()
        table[np.asarray(rows["slot"]), np.asarray(rows["word"])] = np.asarray(rows["bits"]).view(np.uint64)
    fill = np.array([((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    return Model(languages, table, fill**HASHES)


def identify(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """(language, score) per text: the share of its trigrams that the language explains, corrected."""
    labels: list[str] = []
    scores: list[np.ndarray] = []
    for lo, hi in pieces(texts):
        n = hi - lo
        grams, owner, has = trigrams(texts[lo:hi])
        one, two = slots_of(grams, len(model.table))
        size = np.bincount(owner, minlength=n).astype(float)
        counts = np.zeros((n, len(model.languages)))
        masks = model.table[one] & model.table[two]
        for i in range(len(model.languages)):
            hit = ((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.float64)
            c = np.bincount(owner, weights=hit, minlength=n)
            f = model.false_rate[i]
            counts[:, i] = np.maximum(0, (c - size * f) / max(1 - f, 1e-9))
        if model.languages:
            best = counts.argmax(axis=1)
            score = np.where(has, np.clip(counts[np.arange(n), best] / np.maximum(size, 1), 0, 1), 0.0)
            labels += [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, has)]
        else:
            score = np.zeros(n)
            labels += [UNDETERMINED] * n
        scores.append(score)
    return labels, np.concatenate(scores) if scores else np.zeros(0)


def predict(documents: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns, and the predicted language and its score under ``names`` (columns of these names are replaced).

    NULL texts and texts without a letter give ``und`` with score 0; so does every text if nothing was
    learned.  Ties go to the language first in order.
    """
    spark = small_batches(documents.sparkSession)
    shared = spark.sparkContext.broadcast(tuple(model))  # plain values: workers need no class of this package
    columns = [c for c in documents.columns if c not in names]
    at = columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(columns).schema)

    def run(batches):
        for b in batches:
            labels, scores = identify([t or "" for t in b.column(at).to_pylist()], Model(*shared.value))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                                             [*columns, *names])

    return documents.select(columns).mapInArrow(run, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def known_language(documents: DataFrame) -> DataFrame:
    """Documents whose language is recognised; columns stay.

    No document vouches for itself: by crc32(doc_id) mod 2 (NULL ids: 0) each half is judged by what the other half's rows
    that name a language teach.  Half a corpus that teaches nothing judges nothing: all go as undetermined.
    """
    language, score = free_name("language_", documents), free_name("score_", documents)
    half = F.coalesce(bucket_of("doc_id", 2), F.lit(0))
    out = None
    for k in (0, 1):
        predicted = predict(documents.filter(half == k), train(documents.filter(half != k)), (language, score))
        kept = predicted.filter((F.col(language) != UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(*documents.columns)
        out = kept if out is None else out.unionByName(kept)
    return out


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    model = train(documents.filter(bucket_of("doc_id", 4) != 2))
    held = F.coalesce(bucket_of("doc_id", 4) == 2, F.lit(False))
    texts = documents.select("doc_id", held.alias("held_out"), "text")
    return predict(texts, model).select("doc_id", "held_out", "lang_pred", "score")
