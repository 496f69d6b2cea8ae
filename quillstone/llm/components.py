"""Connected components of an edge table, by hooking to the smallest neighbour and pointer jumping.

Each round every node takes the smallest label among its own and its neighbours', then the label of
that label.  Labels never leave the cluster; a round's table is cut from its lineage in the shared
checkpoint folder, and the driver only learns whether any label has changed.  Minima are pre-aggregated,
and joins on a hub's key are plain equi-joins that adaptive execution may split.

Defined results: edges with a null end and loops are ignored, repeated edges and both directions of one count
once; a node without an edge has no row; an empty table gives an empty result; columns besides a and b are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node reachable) for every node of edges (a, b); null ends are ignored."""
    known = edges.where("a is not null and b is not null and a <> b")
    both = cut(known.select("a", "b").union(known.select("b", "a")))
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).select(F.col("a").alias("node"), "comp"))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("low"))
        hooked = labels.join(near, F.col("node") == F.col("a")).select("node", "comp", F.least("comp", "low").alias("next"))
        top = labels.select(F.col("node").alias("root"), F.col("comp").alias("of_root"))
        jumped = cut(hooked.join(top, F.col("next") == F.col("root")).select("node", F.least("next", "of_root").alias("comp"), (F.least("next", "of_root") < F.col("comp")).alias("moved")))
        labels = jumped.select("node", "comp")
        if not jumped.where("moved").take(1):
            return labels
