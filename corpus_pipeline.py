"""The corpus pipeline: documents in, token sequences of the mixed corpus out.

Each stage gets the table that its predecessor wrote and returns one with the columns of
``documents``; the last returns the mixed corpus as tokens. A lost executor costs a read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from swingframe.llm import exact, mixing, near, pieces, store, toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the sentence model does not reject."""
    return toxicity.drop_toxic(docs, store.table(spark, folder, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts, the one with the smallest doc_id."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each class of near duplicates, the one with the smallest doc_id."""
    return near.drop_near_copies(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document at least once; domains short of their target are repeated."""
    labelled = mixing.labelled_domains(docs, store.table(spark, folder, "labels"))
    return mixing.mixed(docs, labelled, mixing.TARGETS, floor=1.0)


def encode_pieces(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, lang, source, n_chars and the tokens of every document."""
    return pieces.encode(docs, ["doc_id", "lang", "source", "n_chars"])


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_domains),
    ("pieces", encode_pieces),
]
ORACLE_SQL = None  # trained models and hash sketches have no SQL twin; tests/llm holds each stage against brute force


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = store.table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.written(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
