"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stage

MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node of
    ``links`` (a, b); links to itself give a component of one.

    Alternates two steps until only stars are left: every node hands its larger
    neighbours over to its least neighbour, then its smaller ones (and
    itself).  Both keep the components, and stars come out.  Each node's
    least neighbour is a partial aggregate, and the links of a hot node
    meet it in a join that Spark splits; no node's links are gathered.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large, "large-star")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(root.select("u", F.col("m").alias("v")).union(small).distinct(), "small-star")
        # done when every node has one edge, to a node that has none
        per = edges.groupBy("u").agg(F.count("*").alias("n"))
        roots = edges.select(F.col("v").alias("u"))
        if not per.where("n > 1").limit(1).count() and not roots.join(per, "u").limit(1).count():
            break
    else:
        raise RuntimeError("components didn't settle")
    found = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
