"""Training-data pipeline: five of the numbered operators, one after another, on ``documents``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table that is written and read again as
the next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, jaccard_join, mixing, quality, substring_dedup
from quire.llm.common import documents
from quire.session import materialize
from quire.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier does not reject."""
    scored = quality.quality_scores(docs, read_table(spark, sf_dir, "labels"))
    return scored.filter(F.col("quality_score") >= quality.REJECT_BELOW).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class."""
    return jaccard_join.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages out of texts that have stood before; ``n_chars`` follows the text."""
    cut = substring_dedup.substring_dedup(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the rows in the order of the mix: the files, in order of their names, interleave the
    sources by their target weights."""
    return mixing.mix_sources(docs).orderBy("mix_position").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to, in the order of the mix.

    Spark reads files in order of size, so the order is taken again from the name of each file
    (longer numbers are later) and the place in it; texts are sorted before they are encoded,
    because the sort looks at its input twice.
    """
    path = F.col("_metadata.file_path")
    mixed = docs.select("doc_id", "lang", "source", "text", F.length(path).alias("__long"),
                        path.alias("__file"), F.col("_metadata.row_index").alias("__row"))
    mixed = mixed.orderBy("__long", "__file", "__row").select("doc_id", "lang", "source", "text")
    both = bpe.bpe_encode_decode(mixed)
    return both.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       "decoded_sha256")


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", source_mix),
    ("BPE encoding and decoding", tokens),
]

#: a classifier learned in numpy and content-defined chunks have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialize(docs, f"stage{number}")
    return docs
