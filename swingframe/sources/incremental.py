"""Bronze by arrival: files that are new since the last run, and nothing twice.

A file stream over the landing folder, run with `availableNow`, reads what has landed since its
checkpoint and stops. The file sink commits a batch's files together, so a run that is lost half way is repeated
without doubling a row. Camera views of one shot are dropped against the views that have
landed before, whose fingerprints are kept as state for as long as `within` says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swingframe.functions.cleaning import header_text
from swingframe.sources.bronze import CSV_OPTIONS, FILES, _label
from swingframe.sources.registry import Source


def new_rows(spark: SparkSession, root: str, source: Source) -> DataFrame:
    """A stream of a source's rows as strings, with the file they come from and when it landed. A stream's
    columns are fixed before a file is seen, so the source has to declare its header."""
    if not source.header or source.has_units_row:
        raise ValueError(f"{source.name} declares no plain header, so its files can only be read whole")
    names = [header_text(c) for c in source.header]
    scan = spark.readStream.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).options(
        **CSV_OPTIONS, header=True, multiLine=source.multi_line, encoding=source.encoding, **FILES).csv(root)
    return scan.select(
        F.lit(source.name).alias("_source"), _label(root).alias("_source_file"), F.col("_metadata.file_modification_time").alias("_landed_at"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in names]).where(F.col("_source_file").rlike(source.path_pattern))


def land_new(
    spark: SparkSession, root: str, source: Source, target: str, checkpoint: str, *,
    conform: Callable[[DataFrame], DataFrame] | None = None, fingerprint: list[str] | None = None, within: str = "7 days",
) -> None:
    """Append what is new below `root` to the table at `target`.

    `conform` types the rows, and with a `fingerprint` only the first row of each is
    kept, also across runs, while its file is no older than `within` against the latest one. Files that
    land later than that are taken for late and left out."""
    rows = new_rows(spark, root, source)
    if conform is not None:
        rows = conform(rows)
    if fingerprint is not None:
        rows = rows.withWatermark("_landed_at", within).dropDuplicatesWithinWatermark(fingerprint)
    query = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
