"""quire: text-corpus analytics on Spark.

Every public function takes and returns DataFrames (or Columns). Library code creates no session,
prints nothing and never collects; the caller owns the ``SparkSession`` and decides what to run.

Subpackages
-----------
sources    readers for book files and the driver tables, deterministic subsets, sinks
functions  Column-level building blocks (header regexes, text cleaning, term hashing)
operators  DataFrame -> DataFrame operators (word count, profiling, TF-IDF, similarity,
           the temporal influence band join, top-k)
plans      named end-to-end queries, tidy reports and batch jobs built from the operators
streaming  the same per-book operators over a directory that grows (Structured Streaming)
"""

__version__ = "0.1.0"
