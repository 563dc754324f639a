"""Session settings, and tables written once in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Re-shuffle rather than leave a hot key in one task when a join feeds a
    # grouping on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "swingframe", **settings: str) -> SparkSession:
    """A session with the library's SQL settings; master and memory come from the caller."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables, removed when its driver ends.

    It lies in `spark.checkpoint.dir`, which the cluster names and every executor reaches; where
    that is unset, in the session's warehouse, which executors share as well."""
    sc = spark.sparkContext
    shared = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = f"{(shared or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/swingframe-{sc.applicationId}"
    if folder not in _OPENED:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(sc._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _OPENED.add(folder)
    return folder


_OPENED: set[str] = set()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else writes to."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table once and read it back: a loop's plan stays short, later steps neither repeat
    the work nor read columns they do not use, and a lost executor costs only a read."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Write a table in as many buckets of `keys` as there are shuffle partitions and read it back. A
    join or grouping on exactly these keys then moves the other side only, however often it is
    repeated. The table's files lie in the shared folder; its name is this session's."""
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"swingframe_{name}_{uuid.uuid4().hex}"
    df.repartition(count, *keys).write.bucketBy(count, *keys).option("path", fresh_path(spark, name)).saveAsTable(table, format="parquet")
    return spark.table(table)
