"""Connected components of a table of edges, as rounds of joins.

Alternating large-star and small-star steps: each node's neighbours move to
the least neighbour, so trees flatten to stars.  The number of edges never
grows and the rounds grow with the logarithm of a component's size.  A node
may have any number of neighbours: its edges are spread by the aggregate that
finds its least neighbour, and the join that follows has a stored table on
either side, so both are plain exchanges, whose large partitions Spark splits.

Defined results: loops and repeated edges change nothing, edges with a null end
are ignored, no edges give an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) other than its component's
    smallest node, with that node as root."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "components-edges")
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "components-least")
        large = stored(both.join(least, "u").where("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "components-large")
        first = stored(large.groupBy("u").agg(F.min("v").alias("m")), "components-first")
        small = (large.join(first, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(first.select("u", F.col("m").alias("v"))).distinct())
        now = stored(small, "components-edges")


def unite(labels, a, b):
    """Merge the groups of a[i] and b[i] in the numpy array ``labels``; a
    group's label is its least number."""
    import numpy as np
    while True:
        x, y = labels[a], labels[b]
        if (x == y).all():
            return labels
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            nxt = labels[labels]
            if (nxt == labels).all():
                break
            labels = nxt
