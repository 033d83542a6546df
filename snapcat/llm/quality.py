"""Quality scores from pairwise preferences (Bradley-Terry).

Every pair of a good and a bad training document says that the first one beats the second.  The
probability of that is the logistic function of the difference of their scores, a score being a
weighted sum of binned text measures; the weights minimise the logistic loss on the feature differences.
The share of bad documents among the training rows, as a quantile of their scores, is the
threshold; scores are moved so that it lies at CUT.

Every labelled row counts: bin edges and threshold are quantiles of counts over all of them, and the rows are
dealt into blocks, each of which gives the weights that fit all its pairs; the model has their mean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.llm.common import Hasher, bucket_of, chunks, load, lower_bytes, ranges, small_batches, stage

#: Rows of a block, and how many of the rarer class each block gets (rows are repeated if there are fewer).
BLOCK, RARE = 4096, 64
#: Scores are counted on this grid for the threshold.
GRID = 1e-3
BINS = 12
RIDGE = 1e-3
CUT = 0.3
MEASURES = ("marks", "upper", "digits", "word_length", "marked_words", "upper_words", "repeated", "distinct", "table",
            "same_lines", "log_words", "line_length", "long_words", "word_ends")


def classes() -> dict[str, np.ndarray]:
    byte = np.arange(256)
    letter = ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122)) | (byte >= 128)
    digit = (byte >= 48) & (byte <= 57)
    space = np.isin(byte, [9, 10, 11, 12, 13, 32])
    return {"upper": (byte >= 65) & (byte <= 90), "letter": letter, "digit": digit, "space": space,
            "mark": ~letter & ~digit & ~space & ~np.isin(byte, list(b".,;:'\"-()?"))}


class Measures:
    def __init__(self) -> None:
        self.of, self.lower, self.hasher = classes(), lower_bytes(), Hasher()

    def distinct_share(self, hashes: np.ndarray, owner: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
        order = np.lexsort((hashes, owner))
        h, o = hashes[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        return np.bincount(o[new], minlength=n) / np.maximum(sizes, 1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, measures); zeros for an empty text."""
        n = len(offsets) - 1
        sums = {k: np.concatenate([[0], np.cumsum(v[data])]) for k, v in self.of.items()}
        size = {k: (v[offsets[1:]] - v[offsets[:-1]]).astype(float) for k, v in sums.items()}
        length = np.maximum(np.diff(offsets), 1)
        starts, ends = ranges(~self.of["space"][data], offsets)
        owner = np.searchsorted(offsets, starts, "right") - 1
        words = np.bincount(owner, minlength=n)
        of_words = lambda flag: np.bincount(owner, weights=flag, minlength=n) / np.maximum(words, 1)
        in_word = {k: v[ends] - v[starts] for k, v in sums.items()}
        hashes = self.hasher(self.lower[data], starts, ends)
        repeated = np.zeros(len(starts))
        repeated[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        line_starts, line_ends = ranges(data != 10, offsets)
        line_owner = np.searchsorted(offsets, line_starts, "right") - 1
        lines = np.bincount(line_owner, minlength=n)
        return np.stack([
            size["mark"] / length, size["upper"] / np.maximum(size["letter"], 1), size["digit"] / length,
            of_words(ends - starts), of_words(in_word["mark"] > 0),
            of_words((in_word["upper"] == in_word["letter"]) & (in_word["letter"] > 1)), of_words(repeated),
            self.distinct_share(hashes, owner, n, words), of_words(in_word["mark"] == ends - starts),
            1 - self.distinct_share(self.hasher(data, line_starts, line_ends), line_owner, n, lines) * (lines > 0),
            np.log1p(words), words / np.maximum(lines, 1), of_words(ends - starts > 14), of_words(in_word["mark"] >= 2),
        ], axis=1)


def measured(documents: DataFrame, extra: list[str]) -> DataFrame:
    """``extra`` columns, and the measures of each text as binary (float64)."""
    small_batches(documents.sparkSession)
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in extra)

    def run(batches):
        measure = Measures()
        for b in batches:
            rows = [row.tobytes() for _, _, data, offsets in chunks(b.column(len(extra))) for row in measure(data, offsets)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(extra)], pa.array(rows, pa.binary())], [*extra, "x"])

    return documents.select(*extra, "text").mapInArrow(run, f"{schema}, x binary")


class Model:
    """Bin edges per measure, weights of the bins, and the threshold."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, threshold: float) -> None:
        self.edges, self.weights, self.threshold = edges, weights, threshold


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Steps: a column per measure and edge, 1 above the edge."""
    return np.concatenate([x[:, [j]] > e[None, :] for j, e in enumerate(edges)], axis=1).astype(float)


def scores(x: np.ndarray, model: Model) -> np.ndarray:
    raw = binned(x, model.edges) @ model.weights - model.threshold
    return 1 / (1 + np.exp(-np.clip(raw + np.log(CUT / (1 - CUT)), -30, 30)))


def coarse(x: np.ndarray) -> np.ndarray:
    """Values with ten bits after the leading one, so that few differ."""
    return (x.astype(np.float32).view(np.uint32) & np.uint32(0xFFFFE000)).view(np.float32).astype(float)


def quantiles(values: np.ndarray, counts: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Of values that occur ``counts`` times."""
    order = np.argsort(values)
    total = np.cumsum(counts[order])
    return values[order][np.minimum(np.searchsorted(total, parts * total[-1]), len(order) - 1)]


def edges_of(counted: dict[tuple[bool, int], tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Bin edges from (values, counts) per class and measure: from both, so that a rare class has bins of its own."""
    part = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.concatenate([quantiles(*counted[c, j], part) for c in (True, False)])) for j in range(len(MEASURES))]


def weights_of(f: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Newton's method on the mean logistic loss of the feature differences, good minus bad, of all pairs."""
    g, b = f[good], f[~good]
    pairs = len(g) * len(b)
    w = np.zeros(f.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip((g @ w)[:, None] - (b @ w)[None, :], -30, 30)))
        gradient = (g.T @ (p - 1).sum(1) - b.T @ (p - 1).sum(0)) / pairs + RIDGE * w
        v = p * (1 - p)
        cross = g.T @ (v @ b)
        hessian = ((g * v.sum(1)[:, None]).T @ g + (b * v.sum(0)[:, None]).T @ b - cross - cross.T) / pairs + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def no_model() -> Model:
    return Model([np.zeros(0)] * len(MEASURES), np.zeros(0), np.log(CUT / (1 - CUT)))  # 0.5 for all


def fit(x: np.ndarray, good: np.ndarray) -> Model:
    """The model of rows at hand: one block."""
    if good.all() or not good.any():
        return no_model()
    counted = {(c, j): np.unique(coarse(x[good == c, j]), return_counts=True) for c in (True, False) for j in range(len(MEASURES))}
    edges = edges_of(counted)
    f = binned(x, edges)
    w = weights_of(f, good)
    raw = np.unique(np.floor(f @ w / GRID), return_counts=True)
    return Model(edges, w, float(quantiles(*raw, np.array([1 - good.mean()]))[0] * GRID))


def unpacked(x) -> np.ndarray:
    """Measures of rows whose ``x`` is binary."""
    return np.frombuffer(b"".join(x), float).reshape(len(x), len(MEASURES))


def _counted(rows: DataFrame, columns: str, of) -> DataFrame:
    """Sums of ``of(quality, measures)``, a record batch of integer columns and n, over all rows."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield of(b.column("quality").to_numpy(zero_copy_only=False) == 1, unpacked(b.column("x").to_pylist()))

    keys = [c.split()[0] for c in columns.split(", ")]
    return rows.select("quality", "x").mapInArrow(run, f"{columns}, n long").groupBy(*keys).agg(F.sum("n").alias("n"))


def _values(good: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    found = [(c, j, *np.unique(coarse(x[good == c, j]), return_counts=True)) for c in (True, False) if (good == c).any() for j in range(len(MEASURES))]
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([np.full(len(v), c) for c, _, v, _ in found])), pa.array(np.concatenate([np.full(len(v), j, np.int32) for _, j, v, _ in found])),
        pa.array(np.concatenate([v for *_, v, _ in found])), pa.array(np.concatenate([n for *_, n in found]).astype(np.int64))], ["good", "measure", "value", "n"])


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """From labels (doc_id, quality 0 or 1) and the texts they name; all of them."""
    chosen = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # An id that names many rows counts once.
    # The labels may be too many to broadcast: measures meet them, not texts.
    rows = stage(measured(documents.select("doc_id", "text"), ["doc_id"]).join(chosen, "doc_id").groupBy("doc_id", "quality").agg(
        F.min("x").alias("x")), "quality")
    sizes = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    if len(sizes) < 2:
        return no_model()
    # Counts per coarse value: their number does not grow with the rows.
    counts = _counted(rows, "good boolean, measure int, value double", _values).toPandas()
    edges = edges_of({key: (part["value"].to_numpy(), part["n"].to_numpy()) for key, part in counts.groupby(["good", "measure"])})

    total, (few, rare) = sum(sizes.values()), min((n, q) for q, n in sizes.items())
    blocks = -(-total // BLOCK)
    copies = min(blocks, -(-RARE * blocks // few))
    # Copies of a rare row go to different blocks.
    shift = F.when(F.col("quality") == rare, F.array(*(F.lit(k * (blocks // copies)) for k in range(copies)))).otherwise(F.array(F.lit(0)))
    dealt = rows.withColumn("shift", F.explode(shift)).select(
        F.pmod(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) + F.col("shift"), F.lit(blocks)).alias("block"), "doc_id", "quality", "x")

    def of_block(key, part):
        import pandas as pd

        part = part.sort_values("doc_id", kind="stable")  # the fit doesn't depend on the order of tasks
        good = part["quality"].to_numpy() == 1
        w = [] if good.all() or not good.any() else [weights_of(binned(unpacked(part["x"]), edges), good).tobytes()]
        return pd.DataFrame({"block": [key[0]] * len(w), "w": w})

    # One row of weights per block.
    fitted = dealt.groupBy("block").applyInPandas(of_block, "block long, w binary").orderBy("block").toArrow()
    w = np.mean([np.frombuffer(v, float) for v in fitted["w"].to_pylist()], axis=0) if len(fitted) else np.zeros(sum(map(len, edges)))

    def cells(good: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        cell, n = np.unique(np.floor(binned(x, edges) @ w / GRID).astype(np.int64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n.astype(np.int64))], ["cell", "n"])

    raw = _counted(rows, "cell long", cells).toPandas()
    at = quantiles(raw["cell"].to_numpy().astype(float), raw["n"].to_numpy(), np.array([1 - sizes[1] / total]))[0]
    return Model(edges, w, float(at * GRID))


def score(documents: DataFrame, model: Model, extra: list[str]) -> DataFrame:
    """``extra`` columns, score and predicted (score >= CUT); NULL texts are scored as empty ones."""
    small_batches(documents.sparkSession)
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in extra)

    def run(batches):
        measure = Measures()
        for b in batches:
            found = [scores(measure(data, offsets), model) for _, _, data, offsets in chunks(b.column(len(extra)))]
            s = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(extra)], pa.array(s), pa.array((s >= CUT).astype(np.int32))], [*extra, "score", "predicted"])

    return documents.select(*extra, "text").mapInArrow(run, f"{schema}, score double, predicted int")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = train(documents.select("doc_id", "text"), labels.filter(bucket_of("doc_id", 5) != 0))
    held = F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return score(documents.select("doc_id", held, "text"), model, ["doc_id", "held_out"])
