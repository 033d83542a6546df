from __future__ import annotations

import math
import random

import numpy as np
import pytest
from compare import connect, differences
from helpers import ODD, SF, clashing, near_duplicate_classes, no_documents, odd_documents, words

from snapcat.llm import decontaminate, embedding_dedup, jaccard
from snapcat.llm.common import load
from snapcat.llm.components import components
from snapcat.llm.queries import SQL


@pytest.mark.parametrize("name,query", [
    ("op2_embedding_dedup", embedding_dedup.op2_embedding_dedup), ("op7_decontaminate", decontaminate.op7_decontaminate)])
def test_matches_sql(spark, name, query):
    assert differences(query(spark, SF), connect(SF), SQL[name]) == []


def test_components(spark):
    random.seed(4)
    links = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {v: v for e in links for v in e}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    linked = {v for a, b in links if a != b for v in (a, b)}
    assert found == {v: find(v) for v in linked if find(v) != v}
    assert components(spark.createDataFrame([], "a long, b long"), "test").collect() == []


VECTORS = "vec_id long, embedding array<float>, label int, extra string, rep string, h1 string"


def vectors_by_hand(rows, threshold=0.93):
    ok = [i for i, (v, e, l) in enumerate(rows) if v is not None and l is not None and e and all(
        x is not None and math.isfinite(x) for x in e) and any(e)]
    links = {i: 0 for i in range(len(rows))}
    root = {i: rows[i][0] for i in range(len(rows))}
    unit = {i: np.array(rows[i][1], np.float32).astype(float) / np.linalg.norm(np.array(rows[i][1], np.float32).astype(float)) for i in ok}
    near = [(a, b) for a in ok for b in ok if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]) and unit[a] @ unit[b] >= threshold]
    for a, b in near:
        links[a] += 1
        links[b] += 1
    for _ in rows:
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    return sorted((str(rows[i][0]), links[i], str(root[i])) for i in range(len(rows)))


@pytest.mark.parametrize("block", [1024, 3])
def test_vectors_with_odd_rows(spark, block):
    random.seed(9)
    rows = [(i, [random.gauss(0, 1) for _ in range(4)], i % 2) for i in range(40)]
    rows += [(100 + i, [x + random.gauss(0, 0.2) for x in rows[i % 7][1]], rows[i % 7][2]) for i in range(30)]
    rows += [(200, [0.0] * 4, 0), (201, None, 0), (202, [1.0, None, 0.0, 0.0], 0), (203, [1.0, float("nan"), 0.0, 0.0], 0), (204, [], 0),
             (205, [1.0, 2.0, 3.0, 4.0], None), (None, rows[0][1], 0), rows[0], rows[0], (206, [1.0, 0.5], 0), (207, [2.0, 1.0], 0),
             (208, [float("inf"), 0.0, 0.0, 0.0], 0), (209, [1e-30, 2e-30, 3e-30, 1e-30], 1), (210, [1e30, 2e30, 3e30, 1e30], 1)]
    df = spark.createDataFrame([(*r, "e", "r", "h") for r in rows], VECTORS)
    found = embedding_dedup.near_duplicates(df, block=block).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found) == vectors_by_hand(rows)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in found)


@pytest.mark.parametrize("dim", [2, 4, 9])
def test_tiny_and_huge_components_spoil_nothing(spark, dim):
    """Norms under- or overflow for these vectors, but directions do not."""
    draw = random.Random(dim)
    rows = []
    for k in range(30):
        v = [draw.gauss(0, 1) for _ in range(dim)]
        for scale in (1.0, 1e-200, 1e200, 1e-308, 1e307):
            rows.append([x * scale * (1 + 1e-4 * draw.random()) for x in v])
    rows += [[5e-324] * dim, [1.0] * dim, [5e-324, *[0.0] * (dim - 1)], [1e308, *[0.0] * (dim - 1)]]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    unit = np.array(rows) / np.abs(np.array(rows)).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= embedding_dedup.COSINE
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {i: int(linked[i].sum()) - 1 for i in range(len(rows))} and max(got.values()) > 3


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_blocks_far_apart_never_meet(spark):
    """Two bundles of directions: pairs of blocks across them are skipped."""
    random.seed(2)
    rows = [(i, [1.0 if i % 2 else -1.0, random.gauss(0, 0.01), random.gauss(0, 0.01)], 0) for i in range(200)]
    _, reps = embedding_dedup.representatives(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    sequence = embedding_dedup.blocks(reps, 0.93, 10).cache()
    assert embedding_dedup.near_pairs(sequence, 0.93).count() < 0.6 * sequence.count() * (sequence.count() + 1) / 2


def test_jaccard_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in load(spark, SF, "documents").select("doc_id", "text").collect()]
    want = near_duplicate_classes(rows)
    found = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.op6_ngram_jaccard(spark, SF).collect()}
    assert found == {rows[i][0]: v for i, v in want.items()}


def test_jaccard_splits_large_nodes(spark, monkeypatch):
    """Small nodes and blocks: recursion and block pairs give what one comparison gives."""
    monkeypatch.setattr(jaccard, "BUCKET", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    random.seed(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(i % 4):
            text[random.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(base[:30] + [f"y{i}-{k}" for k in range(60)])) for i in range(40)]  # a passage in common
    found = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {rows[i][0]: v for i, v in near_duplicate_classes(rows).items()}


def test_misses_of_a_pair_at_the_threshold(monkeypatch):
    """The formula against paths that are drawn; the production figures keep the stated recall, the agreement cut included."""
    runs, at = jaccard.runs_needed(jaccard.THRESHOLD, jaccard.RECALL), jaccard.THRESHOLD
    least = math.ceil(jaccard.AGREEMENT * jaccard.COORDINATES)
    cut = sum(math.comb(jaccard.COORDINATES, k) * at**k * (1 - at) ** (jaccard.COORDINATES - k) for k in range(least))
    assert jaccard.miss(at, runs) + cut <= 1 - jaccard.RECALL < jaccard.miss(at, runs - 1)
    with pytest.raises(ValueError):
        jaccard.runs_needed(0.2, jaccard.RECALL)
    monkeypatch.setattr(jaccard, "COORDINATES", 12)
    draw = random.Random(3)

    def meets(equal, depth):
        return depth == 0 or any(equal[draw.randrange(3, 12)] and meets(equal, depth - 1) for _ in range(jaccard.BRANCH))

    lost, rounds = 0, 20_000
    for _ in range(rounds):
        equal = [draw.random() < 0.6 for _ in range(12)]
        lost += not any(equal[run] and meets(equal, 3) for run in range(3))
    assert abs(lost / rounds - jaccard.miss(0.6, 3, depth=3)) < 0.015


def test_sets_are_compared_by_whole_hashes():
    """Hashes that agree in their upper half only are different shingles."""
    upper = np.arange(1, 101, dtype=np.uint64) << np.uint64(32)
    ids, one = np.array([1, 2]), np.array([1, 1])

    def links(other):
        items = [upper.tobytes(), other.tobytes()]
        return jaccard.compare_unit(1, ids, np.array([2, 2]), np.array([100, 100]), one, items, [np.array([1])] * 2, 0.8)

    assert links(upper + np.uint64(7)) is None
    assert links(np.concatenate([upper[:90], upper[90:] + np.uint64(7)]))[1].tolist() == [1, 1]


def test_jaccard_odd_rows(spark):
    near = " ".join(f"t{i}" for i in range(100))
    rows = ODD + [(20, near, "en", "s", 1), (21, near + " more", "en", "s", 1), (19, near, "en", "s", 1), (30, "two words", "en", "s", 1), (31, "Two WORDS!", "en", "s", 1)]
    documents = clashing(spark.createDataFrame(rows, odd_documents(spark).schema))
    want = near_duplicate_classes([(r[0], r[1]) for r in rows])
    found = jaccard.jaccard_classes(documents).collect()
    assert sorted((str(r.doc_id), r.n_links, str(r.class_id)) for r in found) == sorted((str(rows[i][0]), n, str(c)) for i, (n, c) in want.items())
    kept = jaccard.one_of_each(documents)
    assert kept.columns == documents.columns
    ids = sorted(str(r.doc_id) for r in kept.select("doc_id").collect())
    assert ids == sorted(map(str, [1, 2, 3, 4, 5, 6, 6, None, 8, 19, 30]))
    assert jaccard.jaccard_classes(no_documents(spark)).collect() == [] and jaccard.one_of_each(no_documents(spark)).collect() == []


def contamination(text, items):
    w = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        v = words(item)
        m = min(13, len(v))
        windows = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if v else set()
        for p in range(len(w) - m + 1):
            if tuple(w[p : p + m]) in windows:
                hit.update(range(p, p + m))
                found.add(item_id)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None), bool(hit) and 20 * len(hit) >= len(w)


def test_contamination_by_hand(spark):
    random.seed(6)
    item = [f"i{k}" for k in range(20)]
    items = [(1, " ".join(item)), (2, "Short item here"), (3, None), (4, ""), (None, "nobody knows this id"), (5, " ".join(["a"] * 15)), (1, "short ITEM, here")]
    texts = [" ".join(item[3:15]), " ".join(item[3:16]), "x " * 40 + " ".join(item) + " y" * 700, "A short item here, again short item here", None, "",
             "nobody knows this id", "a " * 50, "a " * 12, " ".join(item[:12] + ["z"] + item[12:]), "short item"]
    for _ in range(30):
        parts = [random.choice([" ".join(item[a : a + random.randint(5, 20)]), "u v w", "short item here", "a " * random.randint(1, 16)]) for a in range(4)]
        texts.append(" ".join(parts))
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[1])]
    documents = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    benchmark = spark.createDataFrame([(*i, "k") for i in items], "item_id long, text string, fp string")
    found = decontaminate.decontaminate(documents, benchmark).collect()
    key = lambda r: tuple(map(str, r))
    want = sorted(((i, *contamination(t, items)) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found), key=key) == want
    kept = decontaminate.clean(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(str(i) for i, t in rows if not contamination(t, items)[3])
    none = benchmark.limit(0)
    assert not any(r.contaminated for r in decontaminate.decontaminate(documents, none).collect())
    assert decontaminate.decontaminate(no_documents(spark), benchmark).collect() == []
