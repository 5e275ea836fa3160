"""Connected classes of a link table, shared by the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.tables import written_table


def classes(links: DataFrame) -> DataFrame:
    """(id, component) for each id of the links (a, b): component is the smallest id reachable, itself included.

    Every round takes the smallest label next to an id and then the label of that label, until nothing
    changes; the rounds grow with the logarithm of the longest chain. The labels next to an id are first
    reduced in each task, and both sides of every join are read from written tables, whose partitions
    Spark can split, so one id with very many links or one label of very many ids is no large group. A
    lost executor costs one step at most.
    """
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    both = written_table(links.where("a <> b").select(F.inline(ends)).distinct(), "links")
    nodes = both.groupBy(F.col("u").alias("id")).agg(F.least(F.col("u"), F.min("v")).alias("label"))
    nodes = written_table(nodes, "labels")
    while True:
        near = both.join(nodes, both.v == nodes.id).groupBy(F.col("u").alias("id")).agg(F.min("label").alias("near"))
        lower = nodes.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = written_table(lower, "labels")
        parents = lower.select(F.col("id").alias("parent"), F.col("label").alias("above"))
        step = lower.join(parents, lower.label == parents.parent, "left").select(
            "id", "old", F.least("label", F.coalesce("above", "label")).alias("label")
        )
        step = written_table(step, "labels")
        nodes = step.select("id", "label")
        if step.where("label < old").isEmpty():
            return nodes.select("id", F.col("label").alias("component"))
