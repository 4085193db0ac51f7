"""Batch jobs end to end on temp directories, and the streaming forms."""

import os
import tempfile

from quire.plans import jobs
from quire.streaming import stream_metadata, stream_word_count

LYRICS = ("We're up all night till the sun\nWe're up all night to get some \n"
          "We're up all night for good fun\nWe're up all night to get lucky\n")


def _book(i, author, year):
    return (f"Title: Book {i}\nAuthor: {author}\nRelease Date: June 5, {year} [EBook #{i}]\n"
            f"Language: English\nCharacter set encoding: UTF-8\n\nThe whale and the sea {i}.\n")


def _library(root, books):
    d = os.path.join(root, "books")
    os.makedirs(d, exist_ok=True)
    for i, (author, year) in enumerate(books):
        with open(os.path.join(d, f"book{i:02d}.txt"), "w") as fh:
            fh.write(_book(i, author, year))
    return d


def test_batch_jobs(spark, tmp_path):
    d = _library(str(tmp_path), [("A", 2000), ("B", 2005), ("B", 1995), ("C", 2010), ("D", 2000)])
    books_pq = str(tmp_path / "books.parquet")
    assert jobs.load_books_job(spark, d, books_pq).count() == 5

    meta = jobs.metadata_job(spark, books_pq, str(tmp_path / "meta"))
    assert spark.read.parquet(meta["metadata_extracted"]).count() == 5
    years = spark.read.option("header", "true").csv(meta["temporal_distribution"])
    assert sorted((int(r.year), int(r["count"])) for r in years.collect()) == [
        (1995, 1), (2000, 2), (2005, 1), (2010, 1)]

    net = jobs.network_job(spark, books_pq, str(tmp_path / "net"))
    deg = {r.author: (r.in_degree, r.out_degree)
           for r in spark.read.parquet(net["author_metrics"]).collect()}
    assert deg == {"A": (1, 2), "B": (2, 3), "C": (3, 0), "D": (1, 2)}

    simp = jobs.similarity_job(spark, books_pq, str(tmp_path / "sim"), num_books=4, top_k=2)
    assert spark.read.parquet(simp["similarities"]).count() == 3
    assert spark.read.parquet(simp["top_similar"]).count() == 2
    assert spark.read.parquet(simp["tfidf_vectors"]).count() == 4
    summary = {(r.section, r.key): r.value for r in spark.read.parquet(simp["summary"]).collect()}
    assert summary[("config", "books")] == 4.0 and summary[("config", "features")] == 2000.0
    assert ("config", "book00.txt") in summary  # the target, smallest key
    assert sum(1 for s, _ in summary if s == "top_similar") == 2


def test_word_count_job(spark, tmp_path):
    src = tmp_path / "lyrics.txt"
    src.write_text(LYRICS)
    out = jobs.word_count_job(spark, str(src), str(tmp_path / "wc"))
    lines = []
    for f in sorted(os.listdir(out)):
        if f.startswith("part-"):
            lines += (tmp_path / "wc" / f).read_text().splitlines()
    assert lines[0] == "We're\t4" and "for\t1" in lines and len(lines) == 14


def test_streaming_metadata_and_word_count(spark, tmp_path):
    d = _library(str(tmp_path), [("A", 2000), ("B", 2005)])
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-", dir=str(tmp_path))
    q = (stream_metadata(spark, d).writeStream.format("memory").queryName("meta_stream")
         .option("checkpointLocation", ckpt + "/m").outputMode("append").start())
    q.processAllAvailable()
    with open(os.path.join(d, "book99.txt"), "w") as fh:
        fh.write(_book(99, "E", 1990))
    q.processAllAvailable()
    q.stop()
    rows = {r.file_name: (r.author, r.year) for r in spark.sql("select * from meta_stream").collect()}
    assert rows == {"book00.txt": ("A", 2000), "book01.txt": ("B", 2005), "book99.txt": ("E", 1990)}

    w = (stream_word_count(spark, d).writeStream.format("memory").queryName("wc_stream")
         .option("checkpointLocation", ckpt + "/w").outputMode("complete").start())
    w.processAllAvailable()
    w.stop()
    counts = {r.word: r["count"] for r in spark.sql("select * from wc_stream").collect()}
    assert counts["whale"] == 3 and counts["Author:"] == 3
