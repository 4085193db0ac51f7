"""Session helpers for scripts, tests and the benchmark.

Library functions never build a session; these helpers exist for entry points only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every entry point wants. AQE re-plans joins from runtime sizes (broadcast only when the
# measured side is below the threshold), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "quire",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, for intermediate tables.

    It is ``spark.checkpoint.dir`` as the session names it. Only where that is unset (tests, a
    laptop) a folder of the SQL warehouse is used: Spark itself requires the warehouse to be
    readable and writable by every executor, so this is never a machine-local temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (base or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


#: Spark then drops the shuffle files of an execution at its end, not when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    Later stages re-read the table instead of recomputing the chain (a lost executor costs a
    re-read), with column pruning and the statistics of a real scan; Catalyst cannot push filters
    on expensive expressions below this point. The shuffles of the chain go when the table is written, the files
    when the JVM ends or by :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quire-tables/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    target, system = _file(spark, path)
    system.deleteOnExit(target)
    table = spark.read.schema(schema).parquet(path)
    table.written_to = path
    return table


def _file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(table: DataFrame) -> None:
    """Removes the files of a table that :func:`materialize` returned, when nothing reads it any more."""
    target, system = _file(table.sparkSession, table.written_to)
    system.delete(target, True)
