"""Driver tables and the book views derived from them.

The driver supplies Parquet tables (``/root/testdata/sf*/<name>.parquet``). A book is a
``documents`` row keyed by ``doc_id``. The documents carry no header lines, so header operators run
on a deterministic *headed view*: the same SQL expression runs in Spark and (with ``varchar``) in
the DuckDB oracle, and it prepends Title/Author/Release Date/Language/encoding lines, some missing
on purpose, to every text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Header prepended to each document. `{string}` is the string type name of the dialect.
_HEADED_TEXT_TEMPLATE = """concat(
  case when doc_id % 13 = 0 then 'Title: ' else concat('Title: Book ', cast(doc_id as {string})) end, chr(10),
  case when doc_id % 11 = 0 then '' else concat('Author: Author ', cast(cast(floor(doc_id / 7) as bigint) as {string}), chr(10)) end,
  case when doc_id % 17 = 0 then '' else concat('Release Date: June 5, ',
       cast(1800 + (cast(floor(doc_id / 7) as bigint) * 37) % 190 + (doc_id % 4) * 3 as {string}),
       ' [EBook #', cast(10000 + doc_id as {string}), ']', chr(10)) end,
  'Language: ', lang, chr(10),
  case when doc_id % 7 = 0 then '' else concat('Character set encoding: ',
       case when doc_id % 2 = 0 then 'UTF-8' else 'ISO-8859-1' end, chr(10)) end,
  text)"""


def headed_text_sql(dialect: str = "spark") -> str:
    """The headed-text expression over columns ``doc_id, lang, text`` for ``spark`` or ``duckdb``."""
    return _HEADED_TEXT_TEMPLATE.format(string="string" if dialect == "spark" else "varchar")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``: the books of the driver data. Null text is read as ``""``."""
    return read_table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def headed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` with header lines prepended (see module docstring)."""
    return read_table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(headed_text_sql("spark")).alias("text"))
