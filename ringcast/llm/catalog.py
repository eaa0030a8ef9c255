"""The registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

import functools

import corpus_pipeline
from pyspark.sql import functions as F

from ringcast.llm import (classifier, hnsw, jaccard, langid, line_dedup, negatives, packing, pieces, quality_rules,
                          substring, topk, warc, whitening)
from ringcast.llm.ship import ship
from ringcast.sources.table import Tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship(spark)
            return fn(spark, Tables(spark, sf_dir))
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run
    return deco


@register("op1_ngram_jaccard_join", jaccard.ORACLE_SQL)
def q_jaccard(spark, t):
    return jaccard.jaccard_components(t.documents, width=3, num=90, den=100).drop("cls")


@register("op2_warc", warc.ORACLE_SQL)
def q_warc(spark, t):
    return warc.round_trip(t.pages)


@register("op3_quality_rules", quality_rules.oracle_sql())
def q_quality_rules(spark, t):
    return quality_rules.quality_rules(t.documents, t.labels).drop("text_key")


@register("op4_exact_top_k", topk.ORACLE_SQL)
def q_top_k(spark, t):
    return topk.top_k(t.embeddings, "vec_id % 100 = 0")


@register("op5_line_dedup", line_dedup.ORACLE_SQL)
def q_line_dedup(spark, t):
    return line_dedup.line_dedup(t.documents.select("doc_id", "text")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


@register("op6_quality_classifier")
def q_classifier(spark, t):
    return classifier.classify(t.documents, t.labels)


@register("op7_sentencepiece")
def q_pieces(spark, t):
    return pieces.encode(t.documents, pieces.Model.load(pieces.default_model()), digest=True)


@register("op8_substring_dedup", substring.ORACLE_SQL)
def q_substring(spark, t):
    return substring.substring_digest(t.documents, size=13)


@register("op9_language_id")
def q_langid(spark, t):
    return langid.identify(t.documents)


@register("op10_best_fit_packing")
def q_packing(spark, t):
    return packing.pack(t.documents)


@register("op11_nearest_neighbours")
def q_nearest(spark, t):
    return hnsw.nearest(t.embeddings, "vec_id % 20 = 0")


@register("op12_hard_negatives", negatives.ORACLE_SQL)
def q_hard_negatives(spark, t):
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return negatives.hard_negatives(t.embeddings.withColumn("label", label), "vec_id % 100 = 0")


@register("op13_whitening")
def q_whitening(spark, t):
    return whitening.whiten(t.embeddings)


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def q_pipeline(spark, t):
    return corpus_pipeline.run(spark, t._dir)
