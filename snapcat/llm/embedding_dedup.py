"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with a cosine of at least c lie within eps = sqrt(2 - 2c).  Vectors are sorted by label and by their
cells (of width eps) on the leading principal directions, and cut into blocks of the sequence.  Starting with the
whole sequence, pairs of intervals are split again and again; a pair goes on only while the boxes of its
intervals on the principal directions are within eps, so distant blocks never meet.  Blocks that remain are
compared by one matrix product in double precision.  Directions only decide what can be skipped: the result is exact.

Exact copies are compared once and weighted; of a block pair's links only sums per vector and a star per
component leave the task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapcat.llm.common import load, small_batches, stage
from snapcat.llm.components import components, local_roots

COSINE = 0.93
#: Leading directions, vectors of a block, intervals that an interval is split into.
DIRECTIONS, BLOCK, FAN = 6, 1024, 8
#: Directions come from at most so many vectors, by the hash of their id; every vector is sorted and joined.
SAMPLE = 5000


def representatives(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(every vector with the key of its copies, one row per distinct valid vector and label)."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))
    members = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.cast("array<double>").alias("embedding"),
        valid.alias("valid"), F.xxhash64("label", x).alias("h1"), F.xxhash64(F.lit(7), "label", x).alias("h2"))
    reps = members.filter("valid").groupBy("label", "h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
    return members.select("vec_id", "valid", "label", "h1", "h2"), stage(reps, "vec-reps")


def directions(reps: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension of the vectors, their leading principal directions (columns)."""
    out = {}
    sample = reps.orderBy(F.xxhash64("rep")).limit(SAMPLE).select("embedding").toArrow()["embedding"].to_pylist()
    for d in {len(v) for v in sample}:
        x = unit(np.array([v for v in sample if len(v) == d]))
        values, vectors = np.linalg.eigh(np.cov(x, rowvar=False) if len(x) > 1 and d > 1 else np.eye(d))
        out[d] = vectors[:, np.argsort(values)[::-1][:DIRECTIONS]]
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def blocks(reps: DataFrame, cosine: float, block: int) -> DataFrame:
    """Sequence of blocks: id in the order, label, dim, members, and box on the leading directions."""
    small_batches(reps.sparkSession)
    lead, eps, k = directions(reps), math.sqrt(max(2 - 2 * cosine, 1e-12)), DIRECTIONS

    def project(x: np.ndarray) -> np.ndarray:
        base = lead.get(x.shape[1])
        if base is None:  # a dimension the sample did not see: its first coordinates
            base = np.eye(x.shape[1])[:, :k]
        p = unit(x) @ base
        return np.pad(p, ((0, 0), (0, k - p.shape[1])))

    def cells(batches):
        for b in batches:
            x = b.column(3).to_pylist()
            cell = np.zeros((len(x), k), np.int32)
            for d in {len(v) for v in x}:
                at = [i for i, v in enumerate(x) if len(v) == d]
                cell[at] = np.floor(project(np.array([x[i] for i in at])) / eps)
            size = pa.array([len(v) for v in x], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, size, *(pa.array(cell[:, j]) for j in range(k))], ["label", "rep", "copies", "embedding", "dim", *(f"c{j}" for j in range(k))])

    schema = "label long, rep long, copies long, embedding array<double>, dim int, " + ", ".join(f"c{j} int" for j in range(k))
    order = ["label", "dim", *(f"c{j}" for j in range(k)), "rep"]
    laid = reps.select("label", "rep", "copies", "embedding").mapInArrow(cells, schema)
    laid = laid.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "label", "dim", "rep", "copies", "embedding", F.spark_partition_id().cast("long").alias("part"))

    def cut(batches):
        held: list[tuple] = []
        number = 0

        def emit():
            nonlocal number
            label, dim, part = held[0][0], held[0][1], held[0][5]
            x = np.array([h[4] for h in held])
            p = project(x)
            row = [label, part, number, dim, np.array([h[2] for h in held]).tobytes(), np.array([h[3] for h in held]).tobytes(),
                   unit(x).tobytes(), *p.min(axis=0), *p.max(axis=0)]
            number += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(row, arrow)], [n for n, _ in arrow])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (len(held) == block or held[0][:2] != row[:2]):
                    yield emit()
                held.append(row)
        if held:
            yield emit()

    names = [("label", "long"), ("part", "long"), ("number", "long"), ("dim", "long"), ("ids", "binary"), ("copies", "binary"), ("x", "binary"),
             *((f"{side}{j}", "double") for side in ("lo", "hi") for j in range(k))]
    kinds = {"long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    arrow = [(n, kinds[t]) for n, t in names]
    cutted = stage(laid.mapInArrow(cut, ", ".join(f"{n} {t}" for n, t in names)), "vec-blocks")
    # Place in the sequence: a running count over partitions.
    shift = cutted.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"))
    return cutted.join(shift, "part").withColumn("id", F.col("number") + F.col("shift")).drop("part", "number", "shift")


def near_pairs(sequence: DataFrame, cosine: float) -> DataFrame:
    """(a, b), a <= b: block pairs of one label whose boxes are within eps, by splitting intervals of the sequence."""
    k, eps2 = DIRECTIONS, 2 - 2 * cosine + 1e-9
    boxes = stage(sequence.select("id", "label", "dim", *(f"{s}{j}" for s in ("lo", "hi") for j in range(k))), "vec-boxes")
    count = boxes.count()
    levels = max(1, math.ceil(math.log(max(count, 2), FAN)))

    def level(n: int) -> DataFrame:
        """Intervals of FAN ** n blocks, apart by label."""
        grouped = boxes.withColumn("id", F.floor(F.col("id") / FAN**n)).groupBy("id", "label", "dim").agg(
            *(F.min(f"lo{j}").alias(f"lo{j}") for j in range(k)), *(F.max(f"hi{j}").alias(f"hi{j}") for j in range(k)))
        return grouped.withColumn("above", F.floor(F.col("id") / FAN))

    apart = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"x.lo{j}") - F.col(f"y.hi{j}"), F.col(f"y.lo{j}") - F.col(f"x.hi{j}")), F.lit(2.0))
                 for j in range(k)), F.lit(0.0))
    top = level(levels)
    pairs = top.select("label", "dim", F.col("id").alias("a"), F.col("id").alias("b")).distinct()
    for n in range(levels - 1, -1, -1):
        x, y = level(n).alias("x"), level(n).alias("y")
        p = pairs.alias("p")
        same = lambda s: (F.col(f"p.label") == F.col(f"{s}.label")) & (F.col("p.dim") == F.col(f"{s}.dim"))
        pairs = stage(
            p.join(x, same("x") & (F.col("p.a") == F.col("x.above"))).join(y, same("y") & (F.col("p.b") == F.col("y.above")))
            .filter((F.col("x.id") <= F.col("y.id")) & (apart <= eps2))
            .select(F.col("p.label").alias("label"), F.col("p.dim").alias("dim"), F.col("x.id").alias("a"), F.col("y.id").alias("b")), "vec-pairs")
    return pairs


def compare(sequence: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """(rep, links, root): links of each vector found in a block pair, and the smallest id of its component there."""

    def run(batches):
        for b in batches:
            reps, links, roots = [], [], []
            for same, dim, ia, ca, xa, ib, cb, xb in zip(*(c.to_pylist() for c in b.columns)):
                ia, ca, xa = np.frombuffer(ia, np.int64), np.frombuffer(ca, np.int64), np.frombuffer(xa, np.float64).reshape(-1, dim)
                ib, cb, xb = np.frombuffer(ib, np.int64), np.frombuffer(cb, np.int64), np.frombuffer(xb, np.float64).reshape(-1, dim)
                near = xa @ xb.T >= cosine
                if same:
                    np.fill_diagonal(near, False)
                    ids, count, square = ia, near @ ca, near
                else:
                    ids, count = np.concatenate([ia, ib]), np.concatenate([near @ cb, near.T @ ca])
                    keep_a, keep_b = near.any(axis=1), near.any(axis=0)
                    near = near[keep_a][:, keep_b]
                    some = np.concatenate([keep_a, keep_b])
                    ids, count = ids[some], count[some]
                    n = int(keep_a.sum())
                    square = np.zeros((len(ids), len(ids)), bool)
                    square[:n, n:] = near
                    square[n:, :n] = near.T
                root = local_roots(square, ids)
                has = count > 0
                reps.append(ids[has])
                links.append(count[has])
                roots.append(root[has])
            if reps:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.int64)) for v in (reps, links, roots)], ["rep", "links", "root"])

    one = sequence.select(F.col("id").alias("a"), F.col("label").alias("l1"), "dim", F.col("ids").alias("ia"), F.col("copies").alias("ca"), F.col("x").alias("xa"))
    two = sequence.select(F.col("id").alias("b"), F.col("ids").alias("ib"), F.col("copies").alias("cb"), F.col("x").alias("xb"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select((F.col("a") == F.col("b")).alias("same"), "dim", "ia", "ca", "xa", "ib", "cb", "xb")
    return both.mapInArrow(run, "rep long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors without an id, label or usable components (NULL, empty, zero, NULL or non-finite entries) link with nothing and
    are their own component; vectors of other length don't link; repeated rows count as other vectors.  Other columns are ignored.
    """
    members, reps = representatives(vectors)
    sequence = stage(blocks(reps, cosine, block), "vec-sequence")
    found = stage(compare(sequence, near_pairs(sequence, cosine), cosine), "vec-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select("rep", "root").distinct(), "vec-components")
    classes = stage(
        reps.select("label", "h1", "h2", "rep", "copies").join(links, "rep", "left").join(
            roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
            F.col("label").alias("label_"), F.col("h1").alias("h1_"), F.col("h2").alias("h2_"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
            F.coalesce("root", "rep").alias("component")), "vec-classes")
    on = F.col("valid") & (F.col("label") == F.col("label_")) & (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_"))
    out = members.join(classes, on, "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS component FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.component, e.vec_id) AS component_id, coalesce(c.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
