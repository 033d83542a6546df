"""From raw documents to packed training sequences: five stages, each over all its predecessor kept.

All but the last return the columns of ``documents``; ``run`` writes each result as Parquet in the shared folder and
rereads it.  SQL cannot express the stages (trained filters, tokenizer): tests compare them with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from snapcat.llm import decontaminate, jaccard, langid, packing, pii
from snapcat.llm.common import load, stage

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a recognised language."""
    return langid.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold benchmark passages."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    return pii.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences; a row per piece."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: No stage but decontamination can be said in SQL.
ORACLE_SQL = None
