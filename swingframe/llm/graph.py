"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swingframe.llm.store import written


def settled(edges: DataFrame) -> bool:
    """Whether every node has one node below it at most, and no node in the middle: then each
    component is a star around its smallest node."""
    ends = edges.select(F.col("u").alias("node"), "v").unionAll(edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("v")))
    around = ends.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"), F.count("v").alias("below"))
    open_ = (F.col("low") < F.col("high")) | ((F.col("below") > 0) & (F.col("below") < F.col("n")))
    return not around.agg(F.max(open_)).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every node of ``links`` (u, v), a written table: root is the smallest node it can reach.

    Large-star and small-star rounds: every node hands its neighbours to the smallest one
    it knows, so chains shorten by a factor each round and a round is two group minima
    (combined before the shuffle) and two equi-joins. Only whether the components are stars reaches the
    driver, which ends the rounds."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    while not settled(edges):
        # large star: neighbours above u join the smallest node around u
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its neighbours below join the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.groupBy("u").agg(F.min("v").alias("root"))
