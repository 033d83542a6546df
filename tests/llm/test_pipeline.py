from __future__ import annotations

import os
import subprocess
import sys

from helpers import LOWER, SF, WORD, near_duplicate_classes, words
from test_tokens import packed_right

import corpus_pipeline
from snapcat.llm import pii
from snapcat.llm.common import load
from snapcat.llm.queries import QUERIES, SQL


def shared_windows(text, items):
    w, hit = words(text), set()
    for item in items:
        v = words(item)
        m = min(13, len(v))
        windows = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if v else set()
        for p in range(len(w) - m + 1):
            if tuple(w[p : p + m]) in windows:
                hit.update(range(p, p + m))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_pipeline_by_hand(spark):
    """All languages here are recognised; the other stages are done by brute force."""
    assert WORD and LOWER
    rows = [(r.doc_id, r.text) for r in load(spark, SF, "documents").select("doc_id", "text").collect()]
    classes = near_duplicate_classes(rows)
    rows = [r for i, r in enumerate(rows) if classes[i][1] == r[0]]
    items = [r.text for r in load(spark, SF, "benchmark").collect()]
    rows = [r for r in rows if not shared_windows(r[1], items)]
    documents = {i: [pii.redact(t)] for i, t in rows}
    packed_right(documents, corpus_pipeline.run(spark, SF).collect())


def test_stages_keep_the_columns(spark):
    docs = load(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "decontamination", "pii", "best_fit_packing"]


def test_registered():
    import __spark_entry__ as driver

    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 14))}


def test_workers_need_no_package(tmp_path):
    """From another folder, without this repository on the workers' path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
from snapcat.llm import langid, pii
from snapcat.llm.common import load
docs = load(spark, {SF!r}, "documents")
print("ROWS", langid.known_language(docs).count(), pii.redacted(docs).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 200 200" in out.stdout, out.stderr[-2000:]
