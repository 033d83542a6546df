"""Training of the quality score takes every labelled row."""

from __future__ import annotations

from snapcat.llm import quality


def test_rows_beyond_the_first_twenty_thousand_teach(spark):
    """Edges and threshold are counted over all 24,000 rows."""
    import numpy as np

    n = 24_000
    rows = [(k, ("plain words here " * (1 + k % 3)) if k % 5 else "#!%& 1234 " * (1 + k % 4)) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(k, int(k % 5 != 0)) for k in range(n)], "doc_id long, quality int")
    seen = []
    real, quality._counted = quality._counted, lambda rows, *a: seen.append(rows.count()) or real(rows, *a)
    try:
        model = quality.train(docs, labels)
    finally:
        quality._counted = real
    assert seen == [n, n]
    found = quality.score(docs, model, ["doc_id"]).toPandas()
    good = found["doc_id"].to_numpy() % 5 != 0
    assert np.min(found["score"][good]) > np.max(found["score"][~good])


def test_a_rare_class_reaches_every_block(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK", 50)
    rows = [(k, "good words and more words" if k % 100 else "#### 12 ##") for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 100 != 0)) for k in range(1000)], "doc_id long, quality int")
    one, two = quality.train(docs, labels), quality.train(docs.repartition(5), labels)
    assert (one.weights == two.weights).all() and one.threshold == two.threshold
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, one, ["doc_id"]).collect()}
    assert max(found[k] for k in range(0, 1000, 100)) < min(v for k, v in found.items() if k % 100)
