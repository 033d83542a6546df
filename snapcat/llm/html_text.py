"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a binary variable: part of the main text or not.  Its own potential comes from
tag, class and id words, share of link text and length; a parent-child potential joins it to
its parent.  Sum-product messages go up from the leaves and down from the root and give each element's
exact marginal; blocks whose element is more likely content than not are the text.

Potentials are log ratios of smoothed counts on labelled pages: fixed labelled ones, and a bounded sample of the
table's own pages that mark their article themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.llm.common import hashed_sample, load, small_batches
from snapcat.llm.html_pages import TAGS, TEXT_TAGS, Tree, labelled_pages, marked_labels, parse, weak_labels

#: Bounded training sample of the table's pages, by the hash of their id and url.
SAMPLE_PAGES = 400
#: Weight of that sample beside the fixed pages, which show more kinds of layout.
TABLE_WEIGHT = 0.1
#: Features of an element and their numbers of values; edges: child's group, parent's label.
TAG_NUMBER = {t: i + 1 for i, t in enumerate(TAGS)}
SIZES = {"tag": len(TAGS) + 1, "hint": 4, "links": 4, "length": 15}
#: Added counts; length and link share say less than their counts do, as neighbours repeat each other's evidence.
SMOOTHING = {"tag": 0.1, "hint": 0.1, "links": 0.5, "length": 0.5, "edge": 0.5}
WEIGHT = {"tag": 1.0, "hint": 1.0, "links": 0.7, "length": 0.4}
LIST_TAGS = frozenset("li ul ol dl dt dd td th tr tbody thead".split())


def features(tree: Tree) -> list[tuple[int, int, int, int]]:
    n = len(tree.tag)
    own, total, linked = [0] * n, [0] * n, [0] * n
    for element, text, of_link in tree.blocks:
        own[element] += len(text)
        total[element] += len(text)
        linked[element] += min(of_link, len(text))
    for i in range(n - 1, 0, -1):
        total[tree.parent[i]] += total[i]
        linked[tree.parent[i]] += linked[i]
    out = []
    for i in range(n):
        share = linked[i] / total[i] if total[i] else 0
        links = 0 if not total[i] else 1 if share < 0.2 else 2 if share < 0.6 else 3
        length = 0 if not own[i] else 1 if own[i] < 15 else 2 if own[i] < 60 else 3 if own[i] < 200 else 4
        kind = 2 if tree.tag[i] in LIST_TAGS else 1 if tree.tag[i] in TEXT_TAGS else 0
        out.append((TAG_NUMBER.get(tree.tag[i], 0), tree.hint[i], links, 5 * kind + length))
    return out


def tally(tree: Tree, labels: list[int]) -> dict[tuple[str, int, int], int]:
    """(feature, value, label) counts of one page."""
    counts: dict[tuple[str, int, int], int] = {}
    for i, values in enumerate(features(tree)):
        keys = [(name, v, labels[i]) for name, v in zip(SIZES, values)]
        if tree.parent[i] >= 0:
            group = int(tree.tag[i] in TEXT_TAGS)
            keys.append(("edge", 2 * group + labels[tree.parent[i]], labels[i]))
        for key in keys:
            counts[key] = counts.get(key, 0) + 1
    return counts


def potentials(tables: list[tuple[dict[tuple[str, int, int], float], float]]) -> tuple[dict[str, list[float]], list[list[float]]]:
    """Log ratio (content : other) per feature value, and log P(label | parent's label) per child group.

    A table of counts has its weight whatever its number of pages.
    """
    total: dict[tuple[str, int, int], float] = {}
    for table, part in tables:
        weight = 1000 * part / max(1, sum(v for (name, _, _), v in table.items() if name == "tag"))
        for key, v in table.items():
            total[key] = total.get(key, 0) + v * weight
    own = {}
    for name, size in SIZES.items():
        count = [[total.get((name, v, y), 0) + SMOOTHING[name] for v in range(size)] for y in (0, 1)]
        own[name] = [WEIGHT[name] * (math.log(count[1][v] / sum(count[1])) - math.log(count[0][v] / sum(count[0]))) for v in range(size)]
    edge = []
    for state in range(4):
        a, b = (total.get(("edge", state, y), 0) + SMOOTHING["edge"] for y in (0, 1))
        edge.append([math.log(a / (a + b)), math.log(b / (a + b))])
    return own, edge


def plus(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(tree: Tree, own: dict[str, list[float]], edge: list[list[float]]) -> list[float]:
    """Log odds that each element is content: sum-product up to the root and down again."""
    n = len(tree.tag)
    names = list(SIZES)
    below = [sum(own[name][v] for name, v in zip(names, values)) for values in features(tree)]  # log ratio from the element down
    message = [0.0] * n  # log ratio that an element's subtree sends to its parent
    states = [edge[2 * (t in TEXT_TAGS) : 2 * (t in TEXT_TAGS) + 2] for t in tree.tag]
    for i in range(n - 1, 0, -1):
        under_other, under_content = states[i]
        message[i] = plus(under_content[0], under_content[1] + below[i]) - plus(under_other[0], under_other[1] + below[i])
        below[tree.parent[i]] += message[i]
    odds = [0.0] * n
    odds[0] = below[0]
    for i in range(1, n):
        above = odds[tree.parent[i]] - message[i]  # what the parent knows without this subtree
        under_other, under_content = states[i]
        odds[i] = below[i] + plus(under_other[1], under_content[1] + above) - plus(under_other[0], under_content[0] + above)
    return odds


def main_text(page: str, own: dict[str, list[float]], edge: list[list[float]]) -> str:
    tree = parse(page)
    odds = marginals(tree, own, edge)
    return "\n".join(text for element, text, _ in tree.blocks if odds[element] > 0)


def train(pages: DataFrame) -> tuple[dict[str, list[float]], list[list[float]]]:
    """Potentials; only counts per feature value reach the driver."""
    small_batches(pages.sparkSession)

    def run(batches):
        total: dict[tuple[str, int, int], int] = {}
        for b in batches:
            for page in b.column(0).to_pylist():
                tree = parse(page)
                labels = weak_labels(tree)
                for key, v in tally(tree, labels).items() if labels else ():
                    total[key] = total.get(key, 0) + v
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array([total[k] for k in keys], pa.int64())], ["feature", "value", "label", "n"])

    sample = hashed_sample(pages.filter("html is not null").select("html", F.xxhash64("page_id", "url", "html").alias("h")), SAMPLE_PAGES)
    # Repeated rows count once.
    counted = sample.groupBy("h").agg(F.first("html").alias("html")).select("html").mapInArrow(run, "feature string, value int, label int, n long").groupBy("feature", "value", "label").agg(
        F.sum("n").alias("n"))
    seen = {(r.feature, r.value, r.label): float(r.n) for r in counted.collect()}
    fixed: dict[tuple[str, int, int], float] = {}
    for page in labelled_pages():
        tree = parse(page)
        for key, v in tally(tree, marked_labels(tree)).items():
            fixed[key] = fixed.get(key, 0) + v
    return potentials([(fixed, 1.0), (seen, TABLE_WEIGHT)])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by a line end), n_chars.

    NULL or empty markup gives an empty text; repeated rows give repeated results; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    own, edge = train(pages)

    def run(batches):
        for b in batches:
            texts = [main_text(p or "", own, edge) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(load(spark, sf_dir, "pages"))
