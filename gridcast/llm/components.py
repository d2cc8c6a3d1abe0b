"""Connected components of a table of links, by repeated grouping in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.sources.tables import cut


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest vertex seen: the larger neighbours if ``large``, else the vertex and its smaller ones."""
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    # Only sums per vertex are shuffled before the join; a vertex with very many links is split by the skew join.
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = near.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u"))
    out = met.filter("v > u" if large else "v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(links: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """One row (``vertex``, ``component``) for each vertex of a link but the smallest of its component, which is its name.

    Alternates large and small star steps until the edges stay the same; each round is written to the shared folder.
    Self links and repeated links don't matter; links with a null end are left out; no links give no rows.
    """
    edges = links.filter(f"`{a}` != `{b}`").select(
        F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v")
    )
    edges, before = cut(edges.distinct()), None
    for _ in range(rounds):
        state = edges.agg(
            F.count("*").alias("n"), F.countDistinct("u").alias("ends"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest"),
        ).first()
        if state["n"] == 0 or (state["n"], state["digest"]) == before:
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        if state["n"] == state["ends"] and before is None and edges.join(
            edges.select(F.col("u").alias("_u")), F.col("v") == F.col("_u"), "left_semi"
        ).isEmpty():  # every vertex hangs on a root already
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        before = (state["n"], state["digest"])
        edges = cut(_stars(_stars(edges, True), False))
    raise RuntimeError(f"components haven't settled in {rounds} rounds")
