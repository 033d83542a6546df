"""Connected components of a distributed list of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcat.llm.common import stage


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest id reachable, for every linked node but the roots themselves.

    ``links`` has two long columns.  Stars are grown in turn towards the smallest neighbour: larger neighbours are
    hung on it, then smaller ones; the number of rounds is logarithmic.  Minima are summed before the shuffle
    and joined back, so a node with very many neighbours is never gathered in one group.
    """
    a, b = links.columns
    edges = stage(
        links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct(), name)
    mark = None
    while True:
        both = edges.union(edges.select(F.col("root"), F.col("node"))).toDF("node", "other")
        least = stage(both.groupBy("node").agg(F.min("other").alias("least")), name)
        hung = both.join(least, "node").filter(F.col("other") > F.col("node")).select(
            F.col("other").alias("node"), F.least("node", "least").alias("root")).distinct()
        hung = stage(hung, name)
        least = stage(hung.groupBy("node").agg(F.min("root").alias("least")), name)
        down = hung.join(least, "node").filter(F.col("root") > F.col("least")).select(F.col("root").alias("node"), F.col("least").alias("root"))
        edges = stage(down.union(least.select("node", F.col("least").alias("root"))).distinct(), name)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges
        mark = now


def local_roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each row's component, from a symmetric matrix of links."""
    label = ids.copy()
    rows, cols = np.nonzero(linked)
    if not len(rows):
        return label
    begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    has = rows[begin]
    while True:
        new = label.copy()
        new[has] = np.minimum(label[has], np.minimum.reduceat(label[cols], begin))
        if (new == label).all():
            return label
        label = new
