"""The registered queries of these operators, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from siftline.llm import bpe, ctw, hosts, langid, negatives, ngram_join, packing, pii, quality, sharding, topk, warc, whitening
from siftline.llm.common import table

RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
EVERY, BEST = 50, 5


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = hosts.outcomes(table(spark, sf_dir, "labels"))
    return hosts.judge(table(spark, sf_dir, "pages"), outcomes, RULES)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled = langid.identify(docs, langid.fit(langid.train_rows(docs)))
    return langid.held_out(labelled).select("doc_id", "held_out", "lang_pred", "score")


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.without_shares(quality.rate(table(spark, sf_dir, "documents")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.with_law(sharding.assign(table(spark, sf_dir, "documents")))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.search(vectors, F.col("vec_id") % EVERY == 0, BEST)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"), pii.fit(pii.labelled(spark)))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    vectors = negatives.quantized(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label)
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_join, op2_warc, op3_host_reputation, op4_language, op5_repetition, op6_sharding, op7_exact_topk,
        op8_packing, op9_context_trees, op10_byte_bpe, op11_whitening, op12_pii,
        op13_hard_negatives, pipeline,
    )
}
ORACLES = {
    "op1_ngram_join": ngram_join.ORACLE,
    "op2_warc": warc.ORACLE,
    "op3_host_reputation": hosts.oracle(RULES),
    "op7_exact_topk": topk.oracle("embeddings", "vec_id", "embedding", EVERY, BEST),
    "op13_hard_negatives": negatives.oracle(
        "embeddings", "vec_id", "embedding", "if(vec_id % 7 = 0, (label + 1) % 10, label)", "vec_id % 100 = 0"
    ),
}
