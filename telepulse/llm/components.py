"""Connected components of links by contraction of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telepulse.llm.tables import saved


def components(nodes: DataFrame, links: DataFrame, label: str = "cc") -> DataFrame:
    """``node, label`` for every row of ``nodes``; label is the smallest node that can be reached over ``links`` (a, b).

    Each round gives a node its smallest neighbour and replaces links by links between what was given, so a round
    at least halves the nodes that still have links. Links of one hub are combined before the shuffle.
    """
    given = nodes.select("node", F.col("node").alias("label"))
    while True:
        links = saved(
            links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
            f"{label}-links",
        )
        if links.isEmpty():
            return given
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = saved(
            both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up")),
            f"{label}-parents",
        )
        given = saved(
            given.join(parents.withColumnRenamed("node", "label"), "label", "left").select(
                "node", F.coalesce("up", "label").alias("label")
            ),
            f"{label}-labels",
        )
        left = parents.select(F.col("node").alias("a"), F.col("up").alias("x"))
        right = parents.select(F.col("node").alias("b"), F.col("up").alias("y"))
        links = links.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
