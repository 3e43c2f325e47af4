"""Connected components of a table of links, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``links`` (two long columns); the component is its smallest node.

    Each round takes the smallest label next to a node and then the label of
    that label, so paths halve. Rounds are written, so a lost executor repeats
    one round at most, and both sides of each join are plain tables that
    adaptive execution can split where one node has very many links.
    """
    both = links.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct()
    links = materialise(both, "links")
    ends = links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    labels = materialise(ends.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("component")), "labels")
    before = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
    while before is not None:
        known = labels.select(F.col("node").alias("n"), F.col("component").alias("c"))
        up = links.join(known, F.col("x") == F.col("n")).select(F.col("y").alias("node"), F.col("c").alias("component"))
        down = links.join(known, F.col("y") == F.col("n")).select(F.col("x").alias("node"), F.col("c").alias("component"))
        near = materialise(up.unionByName(down).unionByName(labels).groupBy("node").agg(F.min("component").alias("component")), "near-labels")
        jumped = near.join(near.select(F.col("node").alias("n"), F.col("component").alias("c")), F.col("component") == F.col("n"), "left")
        labels = materialise(jumped.select("node", F.least("component", F.coalesce("c", "component")).alias("component")), "labels")
        after = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if after == before:
            break
        before = after
    return labels
