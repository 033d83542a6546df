"""Jaccard join of word shingles by chosen paths.

Every document is the set of its runs of five words.  Documents with one set are one class, and
classes are joined.  A class follows random paths: at each node some coordinates of a min-hash vector are
sampled, and for each of them the class goes to the child named by its value there, that is by a shared
sampled shingle; similar sets choose the same path with high probability, others part.  Nodes of at most
BUCKET classes, and larger ones whose sets are alike, are compared in full; the others are split again.  Independent runs
repeat this until a pair at the threshold is met with the target probability.

Large nodes are compared block by block in many tasks.  In a node the min-hash vectors are compared first, and only
sets with a likely partner are fetched and compared exactly.  A pair that meets in several nodes counts
in the one with the smallest key alone.  Only a sum of links per class and a star per component leave a task, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.llm.common import (
    Words, bit_filter, chunks, filter_member, filter_slots, free_name, grams, load, mix, row_key, small_batches, stage)
from snapcat.llm.components import components, local_roots

SHINGLE = 5
THRESHOLD = 0.8
#: Probability with which a pair at the threshold is found, even where every node is split to the end.
RECALL = 0.999999
#: Coordinates of the min-hash vector, coordinates sampled at a node below the root (one at the root).
COORDINATES, BRANCH = 64, 2
#: Classes of a node that is compared without further splitting, splits at most, classes of a block of a larger node.
BUCKET, DEPTH, BLOCK = 512, 8, 512
#: A child that keeps more than this part of its node is compared in full: its sets are alike, and splitting would go on in vain.
ALIKE = 0.5
#: Share of equal coordinates below which a pair's sets are not fetched: a pair at the threshold falls below it
#: with a probability of 1e-12.
AGREEMENT = 0.4
COLUMNS = 4096


def miss(threshold: float, runs: int, depth: int = DEPTH) -> float:
    """Probability that a pair at ``threshold`` never meets in ``runs`` runs whose nodes are all split ``depth`` times.

    A run has a coordinate of its own at the root; below it all runs sample the same others, so they are independent
    only for a given number of those in which the pair agrees.
    """
    shared = COORDINATES - runs
    total = 0.0
    for equal in range(shared + 1):
        below = 1.0
        for _ in range(depth):
            below = 1 - (1 - equal / shared * below) ** BRANCH
        chance = math.comb(shared, equal) * threshold**equal * (1 - threshold) ** (shared - equal)
        total += chance * (1 - threshold * below) ** runs
    return total


def runs_needed(threshold: float, recall: float, depth: int = DEPTH) -> int:
    """Fewest runs after which a pair at the threshold is missed with a probability of at most ``1 - recall``."""
    for runs in range(1, COORDINATES // 2 + 1):
        if miss(threshold, runs, depth) <= 1 - recall:
            return runs
    raise ValueError(f"{COORDINATES} coordinates do not reach a recall of {recall} at a similarity of {threshold}")


def shingles(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their text, by text; a text of fewer words is one shingle."""
    sizes = np.bincount(owner, minlength=n)
    first = np.cumsum(sizes) - sizes
    found = []
    if len(words) >= SHINGLE:
        at = np.flatnonzero(owner[: len(words) - SHINGLE + 1] == owner[SHINGLE - 1 :])
        found.append((grams(words, SHINGLE)[at], owner[at]))
    for m in range(1, SHINGLE):
        short = np.flatnonzero(sizes == m)
        if len(short):
            found.append((mix(grams(words, m) + np.uint64(m))[first[short]], short))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, o = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return h[new], o[new]


def multipliers() -> np.ndarray:
    return np.random.default_rng(11).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketches(documents: DataFrame) -> DataFrame:
    """Per document row: doc_id, rk, d1, d2 (digest of the set), size and sig; NULL digest without words."""
    small_batches(documents.sparkSession)

    def run(batches):
        tokens, factors = Words(), multipliers()
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(2)):
                n = hi - lo
                h, o = shingles(*tokens(data, offsets), n)
                size = np.bincount(o, minlength=n)
                has = size > 0
                begin = (np.cumsum(size) - size)[has]
                sig = np.zeros((n, COORDINATES), np.int32)
                digest = np.zeros((2, n), np.uint64)
                if len(h):
                    for j in range(COORDINATES):
                        sig[has, j] = (np.minimum.reduceat(h * factors[j], begin) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    digest[0, has] = np.add.reduceat(h, begin)
                    digest[1, has] = np.add.reduceat(mix(h + np.uint64(1)), begin)
                none = pa.array(~has)
                columns = [pa.array(digest[k].view(np.int64)) for k in (0, 1)]
                columns = [pa.compute.if_else(none, pa.scalar(None, pa.int64()), c) for c in columns]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * COORDINATES, pa.int32()), pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n), b.column(1).slice(lo, n), *columns, pa.array(size.astype(np.int64)), flat],
                    ["doc_id", "rk", "d1", "d2", "size", "sig"])

    return documents.select(F.col("doc_id").cast("long"), row_key("doc_id", "text").alias("rk"), "text").mapInArrow(
        run, "doc_id long, rk long, d1 long, d2 long, size long, sig array<int>")


def set_table(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, items) of the classes ``wanted`` (cid, rk): their sets as sorted 64-bit hashes."""
    bits = bit_filter(wanted.select("rk"))

    def run(batches):
        tokens, member = Words(), filter_member(bits)
        for b in batches:
            one, two = filter_slots(np.asarray(b.column(0)), len(member))
            b = b.filter(pa.array(member[one] & member[two]))
            for lo, hi, data, offsets in chunks(b.column(1)):
                h, o = shingles(*tokens(data, offsets), hi - lo)
                bound = np.searchsorted(o, np.arange(hi - lo + 1))
                items = [h[s:e].tobytes() for s, e in zip(bound[:-1], bound[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(items, pa.binary())], ["rk", "items"])

    sets = documents.select(row_key("doc_id", "text").alias("rk"), "text").mapInArrow(run, "rk long, items binary")
    return wanted.join(sets, "rk").select("cid", "items")


def paths(classes: DataFrame, runs: int) -> DataFrame:
    """(key, cid, members): classes in the nodes where they are compared."""
    at = lambda c: F.element_at("sig", c + 1)
    rows = classes.select("cid", "sig", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")).select(
        "cid", F.xxhash64("run", at(F.col("run"))).alias("key"), F.lit(None).cast("long").alias("above"))
    leaves = []
    for depth in range(DEPTH + 1):
        rows = stage(rows, "paths-rows")
        # One row per node with company; joined as a table, so that a large node's rows can be split.
        nodes = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.max("above").alias("above")).filter("members > 1"), "paths-nodes")
        met = stage(rows.drop("above").join(nodes, "key"), "paths-met")
        done = (F.col("members") <= BUCKET) | F.coalesce(F.col("members") > ALIKE * F.col("above"), F.lit(False))
        leaves.append(met if depth == DEPTH else met.filter(done))
        large = met.filter(~done)
        if depth == DEPTH or large.isEmpty():
            break
        spread = large.join(classes.select("cid", "sig"), "cid").select("cid", "key", "members", "sig", F.explode(F.sequence(F.lit(0), F.lit(BRANCH - 1))).alias("j"))
        coordinate = (F.lit(runs) + F.pmod(F.xxhash64("key", "j"), F.lit(COORDINATES - runs))).cast("int")
        rows = spread.withColumn("c", coordinate).select("cid", F.xxhash64("key", "c", at(F.col("c"))).alias("key"), F.col("members").alias("above")).distinct()
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return stage(out.select("key", "cid", "members"), "paths-leaves")


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with those of ``right`` (None: with each other)."""
    sets = left if right is None else left + right
    items, number = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(number, minlength=len(items)) > 1  # an item of one set is in no intersection
    column = (np.cumsum(shared) - 1)[number]
    keep = shared[number]
    row, column = row[keep], column[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    n = len(left)
    out = np.zeros((n, n if right is None else len(right)), np.float32)
    for lo in range(0, int(shared.sum()), COLUMNS):
        s, e = np.searchsorted(column, [lo, lo + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[s:e], column[s:e] - lo] = 1
        out += held[:n] @ (held[:n] if right is None else held[n:]).T
    return out


def met_before(key: int, keys: list[np.ndarray]) -> np.ndarray:
    """Pairs that also meet in a node with a smaller key."""
    n = len(keys)
    earlier = [k[k < key] for k in keys]
    number = np.unique(np.concatenate(earlier), return_inverse=True)[1]
    held = np.zeros((n, number.max() + 1 if len(number) else 1), np.float32)
    held[np.repeat(np.arange(n), [len(k) for k in earlier]), number] = 1
    return held @ held.T > 0


def allowed_pairs(key: int, side: np.ndarray, size: np.ndarray, keys: list[np.ndarray], threshold: float) -> np.ndarray:
    """Pairs to compare here: of two blocks one each (``side`` 0 and 1; 2: one block), of fitting size, not met before."""
    allowed = ~met_before(key, keys)
    np.fill_diagonal(allowed, False)
    if side[0] != 2:
        allowed &= side[:, None] != side[None, :]
    return allowed & (np.minimum(size[:, None], size[None, :]) >= threshold * np.maximum(size[:, None], size[None, :]) - 1e-9)


def likely(allowed: np.ndarray, sigs: np.ndarray) -> np.ndarray:
    """Members with a partner whose min-hash vector agrees in at least AGREEMENT of the coordinates."""
    equal = np.zeros(allowed.shape, np.uint8)
    for column in sigs.T:
        equal += column[:, None] == column[None, :]
    return (allowed & (equal >= AGREEMENT * COORDINATES)).any(axis=1)


def compare_unit(key: int, cids: np.ndarray, side: np.ndarray, size: np.ndarray, copies: np.ndarray, items: list[bytes],
                 keys: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(class, links, smallest class of its component) of one node, or of two of its blocks."""
    allowed = allowed_pairs(key, side, size, keys, threshold)
    use = np.flatnonzero(allowed.any(axis=1))
    if not len(use):
        return None
    allowed = allowed[use][:, use]
    sets = [np.frombuffer(items[i], np.uint64) for i in use]
    both = size[use][:, None] + size[use][None, :]
    shared = overlaps(sets, None).astype(np.float64)  # exact counts; the bound needs double precision
    linked = allowed & (shared * (1 + threshold) >= threshold * both - 1e-9)
    has = linked.any(axis=1)
    if not has.any():
        return None
    ids = cids[use]
    return ids[has], (linked @ copies[use])[has], local_roots(linked, ids)[has]


def units(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Runs of rows with equal first three columns, across batches."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and held[0][:3] != row[:3]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


UNIT = ["key", "x", "y"]


def sides(x: int, y: int, blocks: tuple[int, ...]) -> np.ndarray:
    return np.full(len(blocks), 2) if x == y else (np.array(blocks) == y).astype(int)


def candidates(leaves: DataFrame, classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(members of comparison units that have a likely partner there, the nodes of each class)."""

    def run(batches):
        for rows in units(batches):
            if len(rows) < 2:
                continue
            key, x, y = rows[0][:3]
            _, _, _, cids, blocks, size, sigs, keys = zip(*rows)
            allowed = allowed_pairs(key, sides(x, y, blocks), np.array(size), [np.array(k) for k in keys], threshold)
            if allowed.any():
                keep = np.flatnonzero(likely(allowed, np.array(sigs, np.int32)))
                n = len(keep)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([v] * n, pa.int64()) for v in (key, x, y)), pa.array([cids[i] for i in keep], pa.int64()),
                     pa.array([blocks[i] for i in keep], pa.int64())], [*UNIT, "cid", "block"])

    known = stage(leaves.groupBy("cid").agg(F.sort_array(F.collect_set("key")).alias("keys")), "paths-keys")  # at most runs * BRANCH ** DEPTH
    count = F.ceil(F.col("members") / BLOCK)
    placed = leaves.withColumn("block", F.pmod(F.xxhash64("cid"), count)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    placed = placed.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "cid", "block")
    laid = placed.join(classes.select("cid", "size", "sig"), "cid").join(known, "cid").select(
        *UNIT, "cid", "block", "size", "sig", "keys").repartition(*UNIT).sortWithinPartitions(*UNIT)
    return stage(laid.mapInArrow(run, "key long, x long, y long, cid long, block long"), "paths-candidates"), known


def links(members: DataFrame, known: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(cid, links, root) found in the units."""

    def run(batches):
        for rows in units(batches):
            rows = list({r[3]: r for r in rows}.values())  # a repeated document row gives its set again
            key, x, y = rows[0][:3]
            _, _, _, cids, blocks, size, copies, items, keys = zip(*rows)
            found = compare_unit(
                key, np.array(cids), sides(x, y, blocks), np.array(size), np.array(copies), items, [np.array(k) for k in keys], threshold)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in found], ["cid", "links", "root"])

    laid = members.join(sets.join(classes.select("cid", "size", "copies"), "cid").join(known, "cid"), "cid")
    laid = laid.select(*UNIT, "cid", "block", "size", "copies", "items", "keys").repartition(*UNIT).sortWithinPartitions(*UNIT)
    return laid.mapInArrow(run, "cid long, links long, root long")


def jaccard_classes(documents: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document row: doc_id, rk (row key), n_links, class_id (smallest doc_id of the component).

    Links join documents whose shingle sets have a Jaccard similarity of at least ``threshold``; n_links counts all other
    rows linked, equal ones included.  NULL texts and texts without words link with nothing and are
    their own class.  Repeated rows count as documents.  Other columns are ignored.
    """
    rows = stage(sketches(documents), "jaccard-sketches")
    classes = stage(
        rows.filter("d1 is not null").groupBy("d1", "d2").agg(
            F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("sig").alias("sig"),
            F.min("rk").alias("rk")).withColumn("cid", F.xxhash64("d1", "d2")), "jaccard-classes")
    leaves = paths(classes, runs_needed(threshold, recall))
    members, known = candidates(leaves, classes, threshold)
    wanted = stage(members.select("cid").distinct().join(classes.select("cid", "rk"), "cid"), "jaccard-wanted")
    found = stage(links(members, known, classes, set_table(documents, wanted), threshold), "jaccard-links")
    number = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select("cid", "root").distinct(), "jaccard-components").select(F.col("node").alias("cid"), "root")
    named = stage(
        classes.select("d1", "d2", "cid", "rep", "copies").join(number, "cid", "left").join(roots, "cid", "left").select(
            "d1", "d2", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "cid").alias("root")),
        "jaccard-named")
    lowest = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    of_class = stage(named.join(lowest, "root").select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), "n_links", "class_id"), "jaccard-of-class")
    return rows.select("doc_id", "rk", "d1", "d2").join(of_class, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left").select(
        "doc_id", "rk", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("class_id", "doc_id").alias("class_id"))


def one_of_each(documents: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Documents without the near-duplicates of another one: of each class the one with the smallest doc_id stays.

    Of repeated rows one stays.  All columns stay.
    """
    seen = jaccard_classes(documents, threshold, recall)
    kept = seen.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("doc_id", "rk").agg(F.count(F.lit(1)).alias("rows"))
    id_, rk, rows = (free_name(n, documents) for n in ("kept_id", "kept_rk", "kept_rows"))
    kept = stage(kept.toDF(id_, rk, rows), "jaccard-kept")
    on = (row_key("doc_id", "text") == F.col(rk)) & F.col("doc_id").cast("long").eqNullSafe(F.col(id_))
    single = documents.join(kept.filter(F.col(rows) == 1), on, "left_semi")
    repeated = documents.join(kept.filter(F.col(rows) > 1), on, "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_classes(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_links", "class_id", F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
