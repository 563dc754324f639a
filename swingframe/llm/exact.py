"""Exact duplicates by a tree merge of sorted digest runs.

Every row starts in one of 8**rounds runs. A run is sorted by digest and holds, for
each digest, the smallest identifier seen and a count. In round r the eight runs whose
numbers differ in octal digit r only exchange: each receives the digests whose own digit
r is its number and merges the (up to eight) sorted streams, keeping the smallest
identifier of every *verified* digest: runs are ordered by a 64-bit digest, and two
entries are the same text only if their SHA-256 agree too. After the last round a digest
lies in one run. The answers go back down the same tree, so a group of copies that holds a
third of all rows meets any task as at most eight entries, and its rows are answered from
8**rounds places. Texts are read once and never shuffled.

Defined results: a null text is the empty text. Rows without doc_id rank after all
others. Rows that repeat a doc_id and text count each on its own, and one of them stays.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe.llm.store import free_name, written

BLANKS = r"[\x20\x09-\x0D]+"
DIGIT = 3  # bits of a run number that one round settles


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def rounds_for(partitions: int) -> int:
    """Rounds, so that there are at least as many runs as shuffle partitions."""
    return max(2, math.ceil(math.log2(max(partitions, 2)) / DIGIT))


def settled(run: Column, key: Column, turn: int) -> Column:
    """The run that takes a digest in a round: digit ``turn`` comes from the digest."""
    low = DIGIT * turn
    digit = F.shiftright(key, low).bitwiseAND(F.lit(2**DIGIT - 1))
    rest = run.bitwiseAND(F.lit(~((2**DIGIT - 1) << low)))
    return rest.bitwiseOR(F.shiftleft(digit, low))


def leaves(docs: DataFrame, rounds: int) -> DataFrame:
    """doc_id, row, digest columns and first run of every row."""
    text = normalised(F.col("text"))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text"))
    rows = rows.select("doc_id", "row", F.unhex(F.sha2("text", 256)).alias("sha"))
    return rows.select(
        "doc_id", "row", "sha", F.xxhash64("sha").alias("key"),
        F.pmod(F.xxhash64("doc_id", "row"), F.lit(2 ** (DIGIT * rounds))).alias("run"))


def merge(entries: DataFrame, run: Column) -> DataFrame:
    """Merge the entries that meet in a run."""
    return entries.groupBy(run.alias("run"), "key", "sha").agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    rounds = rounds_for(int(spark.conf.get("spark.sql.shuffle.partitions")))
    leaf = written(leaves(docs, rounds), "dedup-leaves")
    entry = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    levels = [written(merge(leaf.select("run", "key", "sha", entry.alias("first"), F.lit(1).cast("long").alias("n")),
                            F.col("run")), "dedup-runs")]
    for turn in range(rounds):
        levels.append(written(merge(levels[-1], settled(F.col("run"), F.col("key"), turn)), "dedup-runs"))
    answer = levels.pop()
    for turn in reversed(range(rounds)):
        child = levels.pop().select(
            F.col("run").alias("child"), settled(F.col("run"), F.col("key"), turn).alias("run"), "key", "sha")
        answer = child.join(answer, ["run", "key", "sha"]).select(F.col("child").alias("run"), "key", "sha", "first", "n")
    return leaf.join(answer, ["run", "key", "sha"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns they have."""
    kept_id, sha, mine, n = (free_name(docs.columns, x) for x in ("kept_id", "kept_sha", "text_sha", "copy"))
    kept = exact_groups(docs).filter("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(sha))
    rows = docs.withColumn(mine, F.sha2(normalised(docs["text"]), 256))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept[kept_id]) & (rows[mine] == kept[sha]), "left_semi")
    first = Window.partitionBy("doc_id", mine).orderBy(mine)
    return rows.withColumn(n, F.row_number().over(first)).filter(F.col(n) == 1).select(*docs.columns)
