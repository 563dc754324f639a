"""Intermediate tables in the shared folder that the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from swingframe.session import checkpoint_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below spark.checkpoint.dir that nothing else writes to."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back: later steps neither repeat the work
    nor see another row order, and a lost executor costs only a read."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with as many underscores as make it differ from the names in use (in any case of letters)."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name
