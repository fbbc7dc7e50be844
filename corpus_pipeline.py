"""From raw documents to training sequences: four stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns the columns of documents; the last returns pieces of packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siftline.llm import langid, ngram_join, packing, quality
from siftline.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are too short or repeat themselves; a null text goes."""
    return quality.kept_rows(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and, if a language could be learnt, those of which none has half of the letters."""
    return langid.kept_rows(docs, langid.fit(langid.train_rows(docs)))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates keep the document with the smallest id."""
    return ngram_join.one_of_each(docs)


def lexical_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences beside its lexical neighbours."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("lexical_packing", lexical_packing),
]

# Rolling hashes, a fitted language model and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
