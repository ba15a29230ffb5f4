"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a grouping and a join over edges; tables between rounds lie in the shared
folder. Labels and edges stay distributed; the driver sees one count and one checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import shared


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (large) or smaller-or-equal (small) neighbours to its smallest neighbour."""
    if large:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = near.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.filter("u <> m").select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node of ``edges`` (u, v: long, no nulls); component is its smallest reachable id."""
    now = shared.materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        now = shared.materialize(_star(_star(now, large=True), large=False), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
