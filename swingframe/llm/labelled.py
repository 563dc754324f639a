"""Labelled rows and whole-table scoring, shared by the trained classifiers."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swingframe.llm.store import free_name
from swingframe.llm.words import pieces


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the identifier as text, modulo ``folds``; -1 for a null identifier."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(-1).cast("long"))


def sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, most: int) -> DataFrame:
    """doc_id, text and y (0 or 1) of at most ``most`` labelled documents of each class.

    ``allowed`` is a condition on doc_id. Identifiers are chosen by hash order from the
    label table alone, so at most 2 * most rows are broadcast, however large the corpus. A
    repeated doc_id counts once."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & allowed)
    known = known.groupBy("doc_id").agg(F.max(label).alias("y"))
    picked = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionAll(picked[1])), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").cast("long").alias("y"))


def trained(rows: DataFrame, train: Callable[[pa.Array, np.ndarray], object]) -> object:
    """What ``train`` makes of the texts and labels of a sample, in order of doc_id.

    One task trains, as its rows are bounded; the driver gets the model only, never a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held := [x for x in batches if x.num_rows]:
            got = pa.Table.from_batches(held).sort_by("doc_id").combine_chunks()
            made = train(got["text"].combine_chunks(), got["y"].to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made)], pa.binary())], names=["model"])

    made = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else train(pa.array([], pa.string()), np.zeros(0, np.int64))


def score_rows(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray], list[pa.Array]], keep: list[str],
               fields: list[T.StructField]) -> DataFrame:
    """``keep`` columns of every row of ``docs`` plus the ``fields`` that ``score`` makes
    from a piece's bytes and text offsets; no shuffle."""
    schema = T.StructType([docs.schema[c] for c in keep] + fields)
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in pieces(batch.column(at)):
                made = score(data, offsets)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], *made], names=schema.names)

    return docs.select(*keep, F.col("text").alias(free_name(keep, "text"))).mapInArrow(run, schema)
