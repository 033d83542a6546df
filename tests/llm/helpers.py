"""Documents with odd rows, and brute-force versions of what the operators share."""

from __future__ import annotations

import re
import zlib

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
#: NULL in every column, empty and very long texts, repeated rows, an id with two texts.
ODD = [
    (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "... 123 !!", None, None, None), (4, LONG, "en", "s", len(LONG)),
    (5, "Ein kurzer Satz über die Straße.", "de", "s", 32), (5, "Ein kurzer Satz über die Straße.", "de", "s", 32),
    (6, "Some plain words that say little.", "en", "s", 33), (6, "Quite another text under the same id.", "en", "s", 37),
    (None, "A text without any id at all.", "en", "s", 29), (8, "東京 ıstanbul × ÷ ​ zero\x00nul", "ja", "s", 30),
]


def odd_documents(spark):
    return spark.createDataFrame(ODD, DOCUMENTS)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def clashing(df):
    """The same rows with more columns, under names the operators use inside."""
    out = df
    for name in ("rk", "score", "lang_pred", "rows", "kept_id", "kept_rk", "bad_rk", "bad_id", "span", "key", "cid", "piece", "length", "language_", "score_"):
        out = out.selectExpr("*", f"'x' AS `{name}`")
    return out


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def held(doc_id, modulus, value):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == value


def shingle_sets(rows):
    """{set: rows' numbers} of five-word shingles."""
    out = {}
    for i, (_, text) in enumerate(rows):
        w = words(text)
        if w:
            out.setdefault(frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))), []).append(i)
    return out


def near_duplicate_classes(rows, threshold=0.8):
    """(links, class id) per row, by comparing all pairs that share a shingle."""
    sets = list(shingle_sets(rows).items())
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    links, inverse = [0] * len(sets), {}
    for k, (items, _) in enumerate(sets):
        for g in items:
            inverse.setdefault(g, []).append(k)
    for k, (a, mine) in enumerate(sets):
        for m in {m for g in a for m in inverse[g] if m > k}:
            b, theirs = sets[m]
            if len(a & b) >= threshold * len(a | b):
                links[k] += len(theirs)
                links[m] += len(mine)
                parent[find(m)] = find(k)
    lowest = {}
    for k, (_, mine) in enumerate(sets):
        ids = [rows[i][0] for i in mine if rows[i][0] is not None]
        if ids:
            lowest[find(k)] = min(ids + [lowest.get(find(k), ids[0])])
    out = {i: (0, r[0]) for i, r in enumerate(rows)}
    for k, (_, mine) in enumerate(sets):
        for i in mine:
            out[i] = (links[k] + len(mine) - 1, lowest.get(find(k)))
    return out
