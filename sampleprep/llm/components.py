"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sampleprep.llm.common import checkpointed


def _state(edges: DataFrame) -> Row:
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node that can be reached.

    Each step joins edges to one minimum per node, so it shuffles in proportion to the edges; a node with very many
    edges is a skewed join that Spark splits. The steps needed grow with the logarithm of the longest chain.
    """
    edges = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = _state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")).select("node", F.least("node", "low").alias("low"))
        large = both.where("v > u").join(least, F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = checkpointed(large.distinct())
        low = large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
        small = large.join(low, F.col("u") == F.col("node"))
        small = small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(low.select(F.col("node").alias("u"), F.col("low").alias("v")))
        edges = checkpointed(small.distinct())
        state = _state(edges)
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
