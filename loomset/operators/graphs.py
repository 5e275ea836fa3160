"""Components and order-dependent selection over an edge table.

The driver only runs the rounds and reads one count per round; lineage is cut by
a reliable checkpoint, so a lost executor does not force earlier rounds again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """Rows (id, component) for every id in edges (a, b); a component is named by its smallest id.

    Each round takes the smallest label among the neighbours and then the label of
    that label, so the number of rounds grows with the logarithm of the diameter.
    """
    # both directions from one pass over the edges, which may be costly to find
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    both = cut_lineage(edges.select(F.inline(ends)).where("u <> v").distinct())
    nodes = cut_lineage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).withColumnRenamed("u", "id"))
    while True:
        near = (
            both.join(nodes, both.v == nodes.id).groupBy("u").agg(F.min("label").alias("seen"))
        )
        lower = nodes.join(near, nodes.id == near.u).select(
            "id", F.col("label").alias("old"), F.least("label", "seen").alias("label")
        )
        parents = lower.select(F.col("id").alias("parent"), F.col("label").alias("up"))
        jumped = lower.join(parents, lower.label == parents.parent, "left").select(
            "id", "old", F.least("label", F.coalesce("up", "label")).alias("label")
        )
        step = cut_lineage(jumped)
        nodes = step.select("id", "label")
        if step.where("label < old").limit(1).count() == 0:
            return nodes.select("id", F.col("label").alias("component"))


def diversity_drops(edges: DataFrame) -> DataFrame:
    """Ids to drop so that no kept row has an earlier kept neighbour.

    ``edges(src, dst)`` point from the earlier to the later row of each too similar
    pair. The result equals going through the rows in order and keeping a row iff
    it is not too similar to any row kept before.
    """
    open_edges = cut_lineage(edges.select("src", "dst").distinct())
    dropped = None
    # every round settles at least the earliest rows that are left, so the rounds end
    while open_edges.limit(1).count():
        heads = open_edges.select(F.col("src").alias("id")).distinct().join(
            open_edges.select(F.col("dst").alias("id")).distinct(), "id", "left_anti"
        )
        lost = cut_lineage(
            open_edges.join(heads, open_edges.src == heads.id, "left_semi").select(F.col("dst").alias("id")).distinct()
        )
        dropped = lost if dropped is None else dropped.unionByName(lost)
        open_edges = cut_lineage(
            open_edges.join(lost, open_edges.dst == lost.id, "left_anti").join(lost, F.col("src") == lost.id, "left_anti")
        )
    return open_edges.select(F.col("dst").alias("id")) if dropped is None else dropped
