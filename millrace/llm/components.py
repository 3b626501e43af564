"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def components(links: DataFrame) -> DataFrame:
    """id and label (smallest id reachable) of every endpoint of ``links`` (a, b).

    Every round each node joins its smallest neighbour, and the links are drawn anew
    between the joined nodes, so the number of links that are left falls by a factor.
    A node with very many links is only a group of a partial minimum. Null endpoints
    and links of a node with itself are ignored.
    """
    edges = stage(links.where("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while True:
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("to"))
        both = both.unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("to")))
        parents = both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("parent"))
        # chains of parents are shortened once, the next rounds do the rest
        up = parents.select(F.col("id").alias("parent"), F.col("parent").alias("above"))
        parents = parents.join(up, "parent", "left").select("id", F.coalesce("above", "parent").alias("parent"))
        parents = stage(parents, "parents")
        if labels is None:
            labels = parents.select("id", F.col("parent").alias("label"))
        else:
            step = parents.select(F.col("id").alias("label"), "parent")
            labels = stage(
                labels.join(step, "label", "left").select("id", F.coalesce("parent", "label").alias("label")), "labels"
            )
        a = parents.select(F.col("id").alias("a"), F.col("parent").alias("pa"))
        b = parents.select(F.col("id").alias("b"), F.col("parent").alias("pb"))
        joined = edges.join(a, "a").join(b, "b").where("pa <> pb")
        edges = stage(
            joined.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges"
        )
        if edges.isEmpty():
            return labels
