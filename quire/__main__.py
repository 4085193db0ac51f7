"""Command line for the batch jobs.

    python -m quire load       BOOKS_DIR OUT_PARQUET
    python -m quire metadata   BOOKS_PARQUET OUT_DIR
    python -m quire similarity BOOKS_PARQUET OUT_DIR [--num-books N] [--features F] [--top K]
                               [--target FILE_NAME]
    python -m quire network    BOOKS_PARQUET OUT_DIR [--window W]
    python -m quire wordcount  INPUT OUTPUT_DIR

The master, memory and shuffle width come from ``spark-submit``/the environment, not from here.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from quire.plans import jobs
from quire.session import DEFAULT_CONF


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="quire")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("load", "metadata", "similarity", "network", "wordcount"):
        s = sub.add_parser(name)
        s.add_argument("input")
        s.add_argument("output")
        if name == "similarity":
            s.add_argument("--num-books", type=int, default=None)
            s.add_argument("--features", type=int, default=2000)
            s.add_argument("--top", type=int, default=5)
            s.add_argument("--target", default=None)
        if name == "network":
            s.add_argument("--window", type=int, default=10)
    a = p.parse_args(argv)

    builder = SparkSession.builder.appName(f"quire-{a.job}")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        if a.job == "load":
            jobs.load_books_job(spark, a.input, a.output)
            result = a.output
        elif a.job == "metadata":
            result = jobs.metadata_job(spark, a.input, a.output)
        elif a.job == "similarity":
            result = jobs.similarity_job(spark, a.input, a.output, num_books=a.num_books,
                                         num_features=a.features, top_k=a.top, target=a.target)
        elif a.job == "network":
            result = jobs.network_job(spark, a.input, a.output, window=a.window)
        else:
            result = jobs.word_count_job(spark, a.input, a.output)
        print(json.dumps({"job": a.job, "outputs": result}))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
