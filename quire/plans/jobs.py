"""End-to-end batch jobs: the original scripts' workflows with explicit paths.

Each job reads its input, runs the operators and writes every result with the sinks; nothing is
printed and nothing is collected. An intermediate that feeds several outputs is materialized once:
an output that later outputs derive from is written and read back (one write is both the result
and the lineage cut); other intermediates go to the checkpoint directory. The corpus is scanned
and parsed once per job (twice for similarity: IDF fit and vector transform).

    load_books_job      book files -> books Parquet (file_name, text)
    metadata_job        books -> metadata Parquet, per-year / language CSVs, encoding and
                        top-author tables, tidy report
    similarity_job      books -> TF-IDF vectors (ML sparse vectors), similarity of every book
                        to the target, the top k and a summary
    network_job         books -> author years, influence edges, author degrees, top lists, summary
    word_count_job      text files -> ``word<TAB>count`` lines sorted by word (refuses an
                        existing output directory, like the MapReduce job)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import fixed_values as fv
from quire.operators import influence as inf
from quire.operators import metadata as mo
from quire.operators import similarity as sim
from quire.operators import tfidf
from quire.operators.wordcount import word_count
from quire.plans import reports
from quire.session import materialize
from quire.sources import books, sinks


def _out(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def _persist_output(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a job output and continue from the written table: one write serves as both the
    result and the lineage cut for the outputs derived from it."""
    sinks.write_parquet(df, path)
    return spark.read.parquet(path)


def load_books_job(spark: SparkSession, books_dir: str, output_path: str) -> DataFrame:
    """Read every ``*.txt`` under ``books_dir`` and write ``(file_name, text)`` as Parquet."""
    df = books.read_book_files(spark, books_dir)
    sinks.write_parquet(df, output_path)
    return spark.read.parquet(output_path)


def metadata_job(spark: SparkSession, books_path: str, out_dir: str,
                 top_authors: int = fv.TOP_AUTHORS_LIMIT) -> dict[str, str]:
    paths = {k: _out(out_dir, k) for k in fv.METADATA_OUTPUTS}
    meta = _persist_output(spark, mo.extract_metadata(spark.read.parquet(books_path)),
                           paths["metadata_extracted"])
    sinks.write_csv(mo.books_per_year(meta), paths["temporal_distribution"], sort_by=["year"])
    lang = mo.language_distribution(meta)
    sinks.write_csv(lang, paths["language_statistics"])
    sinks.write_parquet(mo.encoding_distribution(meta), paths["encoding_distribution"])
    sinks.write_parquet(mo.top_authors(meta, top_authors), paths["top_authors"])
    sinks.write_parquet(reports.metadata_report(meta), paths["summary"])
    return paths


def similarity_job(spark: SparkSession, books_path: str, out_dir: str,
                   num_books: int | None = None, num_features: int = fv.NUM_FEATURES,
                   top_k: int = fv.TOP_K, target: str | None = None,
                   key: str = "file_name") -> dict[str, str]:
    """TF-IDF vectors and the books most similar to ``target`` (default: smallest key).

    ``num_books`` keeps the first n books by key (the original default was 50); None = all.
    Similarity uses the hashed TF-IDF of the saved vectors, as the original did: the weights are
    read back from the written vectors, so the text is processed only by the IDF fit and the
    vector transform.
    """
    docs = books.subset(spark.read.parquet(books_path).select(key, "text"), num_books, key=key)
    docs = materialize(docs) if num_books is not None else docs
    paths = {k: _out(out_dir, k) for k in fv.SIMILARITY_OUTPUTS}
    sinks.write_parquet(tfidf.tfidf_vectors(docs, key, num_features=num_features),
                        paths["tfidf_vectors"])
    weights = tfidf.weights_from_vectors(spark.read.parquet(paths["tfidf_vectors"]), key)
    tgt = target if target is not None else docs.agg(F.min(key)).first()[0]
    if docs.filter(F.col(key) == F.lit(tgt)).limit(1).count() == 0:
        raise ValueError(f"the target {tgt!r} is not in the corpus")
    sims = _persist_output(spark, sim.cosine_to_target(weights, docs, tgt, key=key,
                                                       feature="bucket", weight="weight",
                                                       broadcast_target=True),
                           paths["similarities"])
    top = _persist_output(spark, sim.top_similar(sims, top_k, key=key), paths["top_similar"])
    sinks.write_parquet(reports.similarity_summary(docs, top, tgt, num_features, key=key),
                        paths["summary"])
    return paths


def network_job(spark: SparkSession, books_path: str, out_dir: str,
                window: int = fv.TIME_WINDOW, top: int = fv.TOP_K,
                key: str = "file_name") -> dict[str, str]:
    paths = {k: _out(out_dir, k) for k in fv.NETWORK_OUTPUTS}
    ay = materialize(inf.author_years(spark.read.parquet(books_path), key=key))
    sinks.write_parquet(inf.influence_edges(ay, window), paths["influence_network"])
    degrees = _persist_output(spark, inf.author_degrees(ay, window), paths["author_metrics"])
    sinks.write_parquet(inf.top_influential(degrees, top), paths["top_influential"])
    sinks.write_parquet(inf.top_influenced(degrees, top), paths["top_influenced"])
    sinks.write_parquet(reports.network_summary(ay, degrees, window), paths["summary"])
    return paths


def word_count_job(spark: SparkSession, input_path: str, output_path: str) -> str:
    """Count words of every line of the text input; write ``word\\tcount`` sorted by word."""
    lines = spark.read.text(input_path).withColumnRenamed("value", "text")
    counts = word_count(lines)
    (counts.select(F.concat_ws("\t", "word", F.col("count").cast("string")).alias("value"))
     .write.mode("errorifexists").text(output_path))
    return output_path
