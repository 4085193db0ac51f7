"""The queries of the numbered operators: ``name -> (spark, sf_dir) -> DataFrame``.

Each applies one operator with its production parameters to its whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.llm import (bpe, collocations, hash_forest, hnsw, html_extract, jaccard_join, language_id, lm_scoring,
                       merkle, mixing, quality, substring_dedup, toxicity)
from quire.llm.common import documents, fold
from quire.sources.tables import read_table


def op1_substring_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    gone = F.expr("aggregate(removed_spans, 0L, (n, s) -> n + s.end - s.start)")
    return substring_dedup.substring_dedup(docs).select(
        "doc_id", "text", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        gone.alias("removed_chars"), "removed_spans")


def op2_lm_scoring(spark, sf_dir):
    return lm_scoring.lm_scores(documents(spark, sf_dir))


def op3_mix_sources(spark, sf_dir):
    return mixing.mix_sources(documents(spark, sf_dir)).select(
        "doc_id", "source", "mix_block", "mix_slot", "mix_position")


def op4_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = quality.quality_scores(docs, read_table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.REJECT_BELOW).cast("int").alias("predicted"))


def op5_language_id(spark, sf_dir):
    found = language_id.identify(documents(spark, sf_dir))
    return found.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "lang_pred", "score")


def op6_hash_prefix_forest(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    return hash_forest.nearest_neighbours(rows, rows.filter("vec_id % 50 = 0"))


def op7_html_extract(spark, sf_dir):
    return html_extract.extract_main_text(read_table(spark, sf_dir, "pages"))


def op8_bpe_encode_decode(spark, sf_dir):
    return bpe.bpe_digests(documents(spark, sf_dir))


def op9_jaccard_join(spark, sf_dir):
    found = jaccard_join.near_duplicate_classes(documents(spark, sf_dir))
    return found.select(F.col("key").alias("doc_id"), "class_id", "copy_id", "n_links", "kept")


def op10_hnsw_near_dedup(spark, sf_dir):
    return hnsw.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op11_merkle_manifest(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return merkle.proofs(merkle.build(docs, changed={"text": merkle.newline_tampering()}))


def op12_toxicity(spark, sf_dir):
    scored = toxicity.toxicity_scores(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"), out="score")
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_lm_scoring, op3_mix_sources, op4_quality_classifier, op5_language_id,
    op6_hash_prefix_forest, op7_html_extract, op8_bpe_encode_decode, op9_jaccard_join, op10_hnsw_near_dedup,
    op11_merkle_manifest, op12_toxicity, op13_collocations)}

ORACLES: dict[str, str] = {"op3_mix_sources": mixing.oracle(), "op11_merkle_manifest": merkle.oracle(),
                           "op13_collocations": collocations.oracle()}
