"""CSV exports to bronze: every cell a string, plus lineage columns.

Files of one source may have different headers, so they are read once under
positional columns and each row is placed by the header of its own file. Headers are a table of
layouts, a row for each file, that is joined to the rows; the driver learns the
names that occur and nothing else. Row positions come from the scan itself: rows of one file
block get consecutive ids in one task, and a running sum over the (tiny) table of block counts
turns them into a source-wide index. No row is shuffled for it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swingframe.functions.arrays import bound
from swingframe.functions.cleaning import header_name, header_text
from swingframe.operators import conform
from swingframe.session import written
from swingframe.sources.registry import SOURCES, Source, get_source

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
FILES = {"recursiveFileLookup": True, "pathGlobFilter": "*.csv"}
CELL_BREAK = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'  # a comma with an even number of quotes behind it


def _label(root: str) -> Column:
    """Path below the landing root."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.substring_index(path, root.rstrip("/").split("://")[-1].rstrip("/") + "/", -1)


def header_columns(line: Column) -> Column:
    """Column names of a header line: quotes taken off, repeated names numbered, blanks named by
    position, then made snake case."""
    def bare(c: Column) -> Column:
        return F.when(c.rlike('^".*"$'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)

    def numbered(names: Column) -> Column:
        def with_number(c: Column, i: Column) -> Column:
            before = F.size(F.filter(F.slice(names, F.lit(1), i), lambda x: x == c))
            return header_name(F.when(before > 0, F.concat(c, F.lit("."), before.cast("string"))).otherwise(c))

        return F.transform(names, with_number)

    named = F.transform(F.split(line, CELL_BREAK), lambda c, i: bound(
        bare(c), lambda v: F.when(v == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(v)))
    return bound(named, numbered)


def _line_breaks(source: Source) -> dict[str, str]:
    """Options for encodings whose line end is not one byte. Cells of such a file are read as a whole."""
    wide = source.encoding.upper().startswith(("UTF-16", "UTF-32"))
    return {"encoding": source.encoding, "lineSep": "\n"} if wide else {}


def file_tops(spark: SparkSession, root: str, source: Source) -> DataFrame:
    """`(file, names, second_blank)` per matching file: its header's columns, and whether its second physical
    line is blank.

    Ids of a file's lines are consecutive, so its first two lines are those with the lowest
    even and the lowest odd id: two minima, taken before anything is shuffled."""
    lines = (
        spark.read.format("text").options(**FILES, **_line_breaks(source)).load(root)
        .select(_label(root).alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("line"))
        .where(F.col("file").rlike(source.path_pattern) & (F.col("block") == 0))
    )
    line = F.struct("id", "line")
    even, odd = (F.min(F.when(F.col("id") % 2 == k, line)) for k in (0, 1))
    tops = lines.groupBy("file").agg(even.alias("even"), odd.alias("odd"))

    def text(c: Column) -> Column:
        return F.regexp_replace(F.decode(c, source.encoding), "^\uFEFF|\r$", "")

    second = F.when(F.col("even").isNotNull() & F.col("odd").isNotNull(), F.greatest("even", "odd")["line"])
    return tops.select(
        "file", header_columns(text(F.least("even", "odd")["line"])).alias("names"),
        (F.trim(F.coalesce(text(second), F.lit(""))) == "").alias("second_blank"))


def read_bronze(spark: SparkSession, root: str, source: Source | str) -> DataFrame:
    """All of a source's files as one string table.

    Cells empty in a file that has the column stay `''`; a column the file lacks is
    null. `_row_index` counts rows from 0 in path order.
    """
    source = get_source(source) if isinstance(source, str) else source
    tops = written(file_tops(spark, root, source), "file-tops") if not source.header or source.has_units_row else None
    if source.header:
        columns = list(dict.fromkeys(header_text(c) for c in source.header))
        width = len(source.header)
        declared = F.array(*[F.lit(header_text(c)) for c in source.header])
    else:
        # one row for each name that occurs
        names = tops.select(F.posexplode("names").alias("at", "name")).groupBy("name").agg(
            F.min("at").alias("first"), F.max("at").alias("last")).orderBy("first", "name").collect()
        if not names:
            raise FileNotFoundError(f"no file below {root} matches {source.path_pattern}")
        columns, width = [r["name"] for r in names], 1 + max(r["last"] for r in names)

    cells = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    scan = (
        spark.read.schema(cells).options(**CSV_OPTIONS)
        .options(header=False, multiLine=source.multi_line or bool(_line_breaks(source)), encoding=source.encoding, **FILES)
        .csv(root)
        .select("*", _label(root).alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("id"))
        .where(F.col("file").rlike(source.path_pattern))
    )
    blocks = scan.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(in_file), F.lit(0)))
    if tops is not None:
        blocks = blocks.join(tops, "file")
    else:
        blocks = blocks.withColumn("second_blank", F.lit(True))
    if source.header:
        blocks = blocks.withColumn("names", declared)
    skipped = F.lit(1) + F.when(F.col("second_blank"), 0).otherwise(1 if source.has_units_row else 0)
    # One row per file block: ordering this table is file-listing work.
    everything = Window.partitionBy(F.lit(0)).orderBy("file", "block").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = (
        blocks.withColumn("skipped", skipped)
        .withColumn("kept", F.greatest(F.col("before") + F.col("n") - F.col("skipped"), F.lit(0))
                    - F.greatest(F.col("before") - F.col("skipped"), F.lit(0)))
        .withColumn("start", F.coalesce(F.sum("kept").over(everything), F.lit(0)))
    )
    placed = (
        scan.alias("s").join(blocks.alias("b"), ["file", "block"])
        .withColumn("at", F.col("before") + F.col("id") - F.col("first_id"))
        .where("at >= skipped")
        .withColumn("_cells", F.array(*[f"_c{i}" for i in range(width)]))
    )
    rank = F.col("start") + F.col("at") - F.greatest(F.col("before"), F.col("skipped"))
    return placed.select(
        F.lit(source.name).alias("_source"), F.col("file").alias("_source_file"),
        rank.cast("bigint").alias("_row_index"),
        *[
            F.when(F.array_contains("names", c), F.coalesce(
                F.get("_cells", (F.array_position("names", c) - 1).cast("int")), F.lit(""))).alias(c)
            for c in columns
        ],
        F.current_timestamp().alias("_ingested_at_utc"),
    )


# ---- tables that are replaced whole ---------------------------------------
COMMITS = "commit-log"
COMMIT = "version bigint, folder string"


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMIT).json(f"{path}/{COMMITS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _current(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Number and folder of the last committed version; of two writers of one number, the later name."""
    commits = _commits(spark, path)
    last = commits.agg(F.max(F.struct("version", "folder")).alias("last")).first()["last"] if commits is not None else None
    return (last["version"], last["folder"]) if last else None


def write_table(df: DataFrame, path: str) -> None:
    """Replace a table; running it again gives the same table.

    A version is written beside the others and becomes the table by one appended line of the commit
    log. A write that fails, or a driver lost on the way, leaves the old version as it is, and
    readers never see a part of a table."""
    spark = df.sparkSession
    before = _current(spark, path)
    version = (before[0] if before else 0) + 1
    folder = f"version={version}-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(f"{path}/{folder}")
    spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(folder).alias("folder")) \
        .write.mode("append").json(f"{path}/{COMMITS}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The last committed version of a table; `PATH_NOT_FOUND` where there is none."""
    current = _current(spark, path)
    return spark.read.parquet(f"{path}/{current[1]}" if current else f"{path}/{COMMITS}")


def drop_old_versions(spark: SparkSession, path: str) -> list[str]:
    """Remove all folders of a table but that of its current version, for when no reader is left on
    them; returns their names."""
    current = _current(spark, path)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in system.listStatus(root) if s.getPath().getName().startswith("version=")
           and (current is None or s.getPath().getName() != current[1])]
    for folder in old:
        system.delete(folder, True)
    return sorted(p.getName() for p in old)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not have been landed yet: zero rows of the schema if absent."""
    try:
        return read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ingest(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """One lazy bronze table per registered source (all of them by default)."""
    return {name: read_bronze(spark, root, get_source(name)) for name in (names or list(SOURCES))}


def ingest_and_write(spark: SparkSession, root: str, target: str, names: list[str] | None = None) -> None:
    for name, df in ingest(spark, root, names).items():
        write_table(df, f"{target}/{SOURCES[name].bronze_table}")


def land_session(spark: SparkSession, path: str, player: str) -> DataFrame:
    """A personal export as a bronze table: headers conformed, owner stamped, lineage
    added. Refused when no row carries a ball speed."""
    from swingframe.operators.quantiles import ordinal_rank

    raw = spark.read.options(header=True, inferSchema=False, multiLine=True, **CSV_OPTIONS).csv(path)
    rows = conform.session_rows(raw, player)
    if rows.agg(conform.usable_rows().alias("n")).first().n == 0:
        raise ValueError("no row has a ball speed; check the export's headers")
    numbered = ordinal_rank(rows.withColumn("_id", F.monotonically_increasing_id()), [], "_id")
    return numbered.select(
        F.lit("manual").alias("_source"), F.lit(f"{player}.csv").alias("_source_file"),
        F.col("rank").alias("_row_index"), *rows.columns, F.current_timestamp().alias("_ingested_at_utc"))
