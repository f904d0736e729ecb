"""Connected components of a graph that is given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that links lead to; for nodes in ``links`` (``a``, ``b``).

    Each node points to its smallest smaller neighbour; pointers are followed to their
    end by doubling; links are drawn between the ends. Nodes with smaller neighbours
    drop out, so each round at least halves the nodes that still have links. Rounds
    are written tables of links and nodes, nothing passes the driver but "is it empty".
    """
    pairs = stored(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    found = None
    while not pairs.isEmpty():
        parent = stored(pairs.groupBy("b").agg(F.min("a").alias("p")).select(F.col("b").alias("node"), "p"), "parents")
        while True:
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            jumped = stored(parent.join(up, "p", "left").select("node", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")), "parents")
            parent = jumped.select("node", "p")
            if jumped.filter("moved").isEmpty():
                break
        if found is None:
            roots = pairs.select(F.col("a").alias("node")).distinct().join(parent, "node", "left_anti")
            found = stored(parent.unionByName(roots.select("node", F.col("node").alias("p"))), "components")
        else:
            found = stored(_followed(found, "p", parent), "components")
        pairs = _followed(_followed(pairs, "a", parent), "b", parent)
        pairs = stored(pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    return found.select("node", F.col("p").alias("component"))


def _followed(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    to = parent.select(F.col("node").alias(column), F.col("p").alias("__to"))
    return df.join(to, column, "left").withColumn(column, F.coalesce("__to", column)).drop("__to").select(df.columns)
