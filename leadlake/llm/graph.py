"""Connected components of an edge table, by hooking roots and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.session import materialise


def settled(parent: DataFrame) -> DataFrame:
    """(node, label) with every label a root: each pass follows a label's label, so paths halve. Labels never exceed their nodes."""
    while True:
        up = parent.select(F.col("node").alias("label"), F.col("label").alias("top"))
        further = materialise(parent.join(up, "label").select("node", F.col("top").alias("label"), (F.col("top") != F.col("label")).alias("moved")), "labels")
        if further.filter("moved").isEmpty():
            return parent
        parent = further.select("node", "label")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the least node reachable. ``edges`` has a and b of one orderable type.

    Every node of an edge gets a row; edges with a null end are ignored, repeated edges and loops do no harm, no edges
    give no rows. In a round each root takes the least of its neighbours as parent, if that is less than itself; trees
    are flattened and edges drawn anew between their roots. At least half of the roots that have an edge lose theirs to
    a neighbour, so there are at most log2(nodes) rounds of at most log2(nodes) passes, whatever the shape of the graph.
    Minima are summed up before the shuffle and tables are read back from the shared folder, so a hub's rows can be split
    by AQE in the joins.
    """
    pairs = edges.select("a", "b").filter("a is not null and b is not null and a <> b")
    both = materialise(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    rounds = []
    while not rounds or not both.isEmpty():
        hooked = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label"))
        rounds.append(settled(materialise(hooked, "labels")))
        a, b = (rounds[-1].select(F.col("node").alias(x), F.col("label").alias(f"root_{x}")) for x in "ab")
        between = both.join(a, "a").join(b, "b").filter("root_a <> root_b")
        both = materialise(between.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "edges")
    labels = rounds.pop()
    while rounds:
        top = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        labels = rounds.pop().join(top, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
        if rounds:
            labels = materialise(labels, "labels")
    return labels.withColumnRenamed("label", "component")
