"""Review of drafted column mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe import schemas
from swingframe.constants import MAPPABLE_FIELDS


def parse_proposals(texts: DataFrame, text: str) -> DataFrame:
    """Proposal rows from JSON text; `source_name` is null where a text does not parse."""
    return texts.withColumn("_p", F.from_json(text, schemas.MAPPING_PROPOSAL)).select(
        *[c for c in texts.columns if c != text], "_p.*")


def mapping_rows(proposals: DataFrame) -> DataFrame:
    """One row per proposed mapping, a blank column shown as one to synthesise."""
    return proposals.select("proposal_id", "source_name", F.explode("mappings").alias("m")).select(
        "proposal_id", "source_name", "m.common_field", F.nullif("m.source_column", F.lit("")).alias("source_column"),
        "m.unit_conversion", "m.confidence")


def review(proposals: DataFrame, headers: DataFrame) -> DataFrame:
    """What a reviewer has to look at: mappings by field, common fields without a source
    column, source columns nothing uses, and proposals that did not parse. `headers` is
    `(source_name, source_column)`."""
    broken = proposals.where("source_name IS NULL")
    proposals = proposals.where("source_name IS NOT NULL")
    mapped = mapping_rows(proposals)
    asked = proposals.select("proposal_id", "source_name")
    wanted = asked.select("*", F.explode(F.array(*map(F.lit, MAPPABLE_FIELDS))).alias("common_field"))
    found = mapped.where("source_column IS NOT NULL")
    missing = wanted.join(found.select("proposal_id", "common_field").distinct(), ["proposal_id", "common_field"], "left_anti")
    offered = asked.join(headers, "source_name")
    unused = offered.join(found.select("proposal_id", "source_column").distinct(), ["proposal_id", "source_column"], "left_anti")
    blank = F.lit(None)
    return (
        mapped.select("proposal_id", "source_name", F.lit("mapping").alias("item"), "common_field", "source_column", "confidence")
        .unionByName(missing.select("proposal_id", "source_name", F.lit("missing field").alias("item"), "common_field",
                                    blank.cast("string").alias("source_column"), blank.cast("double").alias("confidence")))
        .unionByName(unused.select("proposal_id", "source_name", F.lit("unused column").alias("item"),
                                   blank.cast("string").alias("common_field"), "source_column", blank.cast("double").alias("confidence")))
        .unionByName(broken.select("proposal_id", "source_name", F.lit("unparsed").alias("item"), blank.cast("string").alias("common_field"),
                                   blank.cast("string").alias("source_column"), blank.cast("double").alias("confidence")))
    )


def ordered_review(reviewed: DataFrame) -> DataFrame:
    return reviewed.orderBy("proposal_id", "item", "common_field", "source_column")
