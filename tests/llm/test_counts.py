"""Prefix trie, collocations and line dedup against SQL and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from compare import connect, differences
from helpers import LOWER, SF, clashing, no_documents, odd_documents

from snapcat.llm import collocations, line_dedup, prefix_trie
from snapcat.llm.common import load
from snapcat.llm.queries import QUERIES, SQL

CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_collocations", "op13_line_dedup"])
def test_sql(spark, name):
    # Phrases that occur 100 times need the larger tables.
    sf = SF.replace("0.001", "0.01") if name == "op12_collocations" else SF
    assert differences(QUERIES[name](spark, sf), connect(sf), SQL[name]) == []


# --- prefix trie


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def spark_hash(*texts):
    seed = 42
    for t in texts:
        seed = xxhash.xxh64_intdigest(t.encode(), seed)
    return signed(seed)


def trie_by_hand(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for turns in convs.values():
        turns.sort(key=lambda t: (t[0], t[1], spark_hash(t[2], t[3])))
    new = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        new[c] = tuple(t[2:] for t in convs.get(c - c % 20, [])[:h]) + tuple(t[2:] for t in turns[h:])
    nodes = {}
    # A trie of plain dictionaries: node -> (parent, depth, words of its text).
    words = lambda t: len([w for w in t.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w])
    edges, info, ended = {}, [(None, 0, 0)], {}
    for c, turns in new.items():
        at = 0
        nodes.setdefault(0, []).append(c)
        for turn in turns:
            if (at, turn) not in edges:
                edges[at, turn] = len(info)
                info.append((at, info[at][1] + 1, words(turn[1])))
            at = edges[at, turn]
            nodes.setdefault(at, []).append(c)
        ended.setdefault(at, []).append(c)
    children, leaves, saved = Counter(parent for parent, _, _ in info if parent is not None), Counter(), Counter()
    for k in reversed(range(len(info))):  # children come after their parents
        if k in nodes:
            leaves[k] += not children[k]
            saved[k] += (len(nodes[k]) - 1) * info[k][2]
            if k:
                leaves[info[k][0]] += leaves[k]
                saved[info[k][0]] += saved[k]
    out = Counter()
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(ended.get(k, [])))
        out[(min(members), info[k][1], min(nodes[info[k][0]]) if k else None, len(members), children[k], leaves[k], saved[k],
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def trie_rows(df):
    return Counter(tuple(r) for r in prefix_trie.trie(df).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def random_conversations(seed, deep):
    """Few different turns, so that prefixes are shared; one conversation over several bands and blocks."""
    draw = random.Random(seed)
    rows = []
    for c in [*range(0, 90), 200, 215, 10_007]:
        if c % 20 == 0 and draw.random() < 0.3:
            continue  # a head that is absent
        for t in range(draw.choice([0, 1, 2, 5, 30])):
            rows.append((c, t, draw.choice(["user", "bot"]), draw.choice(["hi", "hi  there\tyou", ""])))
    rows += [(c, t, "user", f"t{t % 7 if t < deep - c else c} x") for c in (300, 301, 302) for t in range(deep)]
    return rows


@pytest.mark.parametrize("seed, deep", [(1, 40), (2, 1100)])
def test_trie_by_hand(spark, seed, deep):
    rows = random_conversations(seed, deep)
    assert trie_rows(spark.createDataFrame(rows, CONVERSATIONS)) == trie_by_hand(rows)


def test_trie_of_odd_rows(spark):
    rows = [
        (None, 1, "user", "nobody's"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 0, "user", None), (2, 5, "a", "b\nc d"),
        (20, 1, "x", "long " * 50_000), (20, 2, "x", "y"), (20, 3, "x", "y"), (21, 1, "z", "q"), (22, 1, "z", "q"), (25, -3, "", "é\x0bü"), (-7, 1, "n", "neg"),
    ]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    assert trie_rows(df) == trie_by_hand(rows)
    for name in ("d", "p", "q", "rep", "block", "n", "h1", "band"):
        df = df.selectExpr("*", f"'x' AS {name}")
    assert trie_rows(df) == trie_by_hand(rows)
    assert trie_rows(spark.createDataFrame([], CONVERSATIONS)) == Counter()


def test_small_bands_sum_alike(spark):
    rows = random_conversations(5, 70)
    paths = spark.createDataFrame([(c, d, 0 if c < 3 or d < 9 else c, 7 * (d > 0)) for c in range(1, 5) for d in range(41)], "rep long, d long, p long, q long")
    nodes = paths.groupBy("d", "p", "q").agg({"rep": "min"}).toDF("d", "p", "q", "rep").selectExpr("*", "d + p AS v")
    want = sorted(map(tuple, prefix_trie.subtree_sums(nodes, paths, ["v"], 64).collect()))
    for band in (4, 16):
        assert sorted(map(tuple, prefix_trie.subtree_sums(nodes, paths, ["v"], band).collect())) == want
    assert rows


# --- collocations


def pieces_by_hand(text):
    for sign in ".,;:!?\n\x0b\x0c\r":
        text = text.replace(sign, "\n")
    for piece in text.translate(LOWER).split("\n"):
        yield [w for w in piece.replace("\t", " ").split(" ") if w]


def collocations_by_hand(rows, least, top):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        for w in pieces_by_hand(text or ""):
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = {}
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        inside = {}
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(a, inside.get(p[i : i + k], 0))
        found = []
        for p, a in cands.items():
            if inside.get(p, 0) < a:
                score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out[(lang, rank)] = (p.decode(), -a, l, r, n[lang], -score)
    return out


def collocation_rows(df, least, top, spacing=collocations.SPACING):
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(df, least, top, spacing=spacing).collect()}


@pytest.mark.parametrize("least, top, spacing", [(100, 2000, 48), (5, 300, 48), (3, 2000, 1)])
def test_collocations_by_hand(spark, least, top, spacing):
    docs = load(spark, SF, "documents").select("text", "lang")
    rows = [(r.text, r.lang) for r in docs.collect()][:60 if least < 100 else None]
    draw = random.Random(least)
    rows += [(" ".join(draw.choice(["a", "B", "c.", "ü", "d\t", "e\n"]) for _ in range(5000)), None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = collocation_rows(df, least, top, spacing)
    assert got == collocations_by_hand(rows, least, top) and got


def test_collocations_of_odd_rows(spark):
    rows = [(r.text, r.lang) for r in odd_documents(spark).collect()] + [("same words again " * 400, "en"), ("x" * 300_000 + " y", "en"), (" ., ", "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    want = collocations_by_hand(rows, 2, 2000)
    assert collocation_rows(df, 2, 2000) == want and want
    assert collocation_rows(clashing(df).selectExpr("*", "1 AS f", "2 AS n", "'k' AS phrase", "'k' AS k"), 2, 2000) == want
    assert collocation_rows(no_documents(spark), 1, 10) == {}


def test_products_beyond_64_bits(spark):
    big = 9 * 10**18
    cand = spark.createDataFrame([("en", "a b", 10**15)], "lang string, phrase string, a long")
    frequent = spark.createDataFrame([("en", "a", 3 * 10**17), ("en", "b", 7 * 10**15 + 1)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", big)], "lang string, n long")
    assert collocations.scored(cand, frequent, totals).first().score == 1000 * 10**15 * big // (3 * 10**17 * (7 * 10**15 + 1))


# --- line dedup


def lines_by_hand(rows):
    blank = " \t\n\x0b\x0c\r"
    holders = {}
    for i, (doc_id, text) in enumerate(rows):
        for line in set((text or "").split("\n")):
            key = line.strip(blank).translate(LOWER)
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    low = -(1 << 63)
    rank = [low if r[0] is None else r[0] for r in rows]
    out = []
    for i, (doc_id, text) in enumerate(rows):
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            held = holders.get(line.strip(blank).translate(LOWER), ())
            if len(held) < 3 or rank[i] == max(rank[j] for j in held):
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def line_rows(df):
    return Counter(tuple(r) for r in line_dedup.dedup_lines(df).collect())


ODD_LINES = [
    (1, "A line that is long enough to count\nshort\n"), (2, "  a LINE that is long enough to count\t\nshort"), (3, "x\na line that is long enough to count\n\n"),
    (3, "x\na line that is long enough to count\n\n"), (None, "a line that is long enough to count"), (4, None), (5, ""), (6, "\n\n\n"),
    (7, "ein Satz mit ÄÖÜ, der zählt\nein Satz mit äöü, der zählt"), (8, "ein Satz mit ÄÖÜ, der zählt"), (9, "ein Satz mit ÄÖÜ, der zählt\r\nein Satz mit ÄÖÜ, der zählt"),
    (10, "ééééééééééééééééééé"), (11, "ééééééééééééééééééé"), (12, "ééééééééééééééééééé"), (13, "twenty characters are"), (14, "Twenty characters are"),
    (15, "twenty characters are\x0b"), (16, "only nobody's line is here\n" * 3), (None, "only nulls hold this line here"), (None, "only nulls hold this line here\n"),
    (None, "only nulls hold this line here\n."), (20, "long " * 200_000 + "\n" + "a line that is long enough to count"),
]


def test_lines_by_hand(spark, monkeypatch):
    df = spark.createDataFrame(ODD_LINES, "doc_id long, text string")
    assert line_rows(df) == lines_by_hand(ODD_LINES)
    assert line_rows(clashing(df).selectExpr("*", "1 AS line", "1 AS id", "1 AS a", "1 AS goes", "1 AS hid")) == lines_by_hand(ODD_LINES)
    assert line_rows(no_documents(spark)) == Counter()
    # Many shards, some of them copied.
    monkeypatch.setattr(line_dedup, "LINES_PER_SHARD", 4)
    monkeypatch.setattr(line_dedup, "HOT", 1)
    assert line_rows(df) == lines_by_hand(ODD_LINES)
    rows = [(r.doc_id, r.text) for r in load(spark, SF, "documents").collect()]
    assert line_rows(load(spark, SF, "documents")) == lines_by_hand(rows)


def test_hashes_of_ranges_do_not_depend_on_windows(monkeypatch):
    from snapcat.llm import common

    draw = np.random.default_rng(5)
    data = draw.integers(0, 256, 5000).astype(np.uint8)
    starts = draw.integers(0, 5000, 2000)
    ends = np.minimum(starts + draw.integers(0, 900, 2000), 5000)
    want = common.Hasher()(data, starts, ends)
    monkeypatch.setattr(common, "CHUNK_BYTES", 256)
    assert (common.Hasher()(data, starts, ends) == want).all()
    assert (common.Hasher()(data[:200], starts[:0], ends[:0])).tolist() == []


def test_filter_grows_with_its_keys(spark, monkeypatch):
    from snapcat.llm import common

    keys = spark.range(20_000).selectExpr("xxhash64(id) AS k")
    monkeypatch.setattr(common, "FILTER_BITS", 1 << 10)
    member = common.filter_member(common.bit_filter(keys))
    assert len(member) == 1 << 19
    one, two = common.filter_slots(np.asarray([r.k for r in keys.collect()], np.int64), len(member))
    assert (member[one] & member[two]).all()
    other = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 50_000, np.int64)
    one, two = common.filter_slots(other, len(member))
    assert (member[one] & member[two]).mean() < 0.02


def test_perfect_hash():
    for n in (0, 1, 2, 1000, 70_000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 64, n, np.uint64))
        levels, number = line_dedup.perfect_hash(keys)
        assert sorted(number) == list(range(len(keys)))
        assert (line_dedup.look_up(levels, keys) == number).all()


def test_keys_with_one_first_half():
    import pyarrow as pa

    rows = pa.table({"a": [5, 5, 6], "b": [1, 2, 3], "n": [3, 4, 5], "largest": [7, 8, 9]})
    index = line_dedup.build_shard((pa.scalar(0),), rows)
    lines = pa.table({"a": [5, 5, 5, 6], "b": [1, 2, 3, 3], "id": [7, 7, 7, None], "rk": [0, 1, 2, 3], "line": pa.array([0, 0, 0, 0], pa.int32())})
    assert line_dedup.probe(3)(index, lines)["rk"].to_pylist() == [1, 3]
