"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstate.llm.common import checkpointed


#: Links of a partition.
LINKS = 200_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links(a, b)`; root is the smallest node.

    Each round hooks every component to its smallest neighbour, follows the hooks to
    their ends and relabels the links, which shrink until none joins two components.
    Only minima are gathered per key, and lineage is cut in the shared folder, so a
    node that holds a third of the links is no hot task. Tables are kept in as many
    partitions as their links need, `LINKS` each.
    """
    pairs = checkpointed(links.where("a <> b").select("a", "b").distinct())
    parts = max(1, -(-pairs.count() // LINKS))
    pairs = pairs.coalesce(parts)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    labels = checkpointed(nodes.select("node", F.col("node").alias("root")), parts)
    while not pairs.isEmpty():
        both = pairs.union(pairs.select("b", "a"))
        hooks = checkpointed(both.groupBy("a").agg(F.min("b").alias("low")).where("low < a"), parts)
        while True:  # follow the hooks: each pass halves the way to the end
            nxt = hooks.select(F.col("a").alias("low"), F.col("low").alias("lower"))
            jumped = checkpointed(hooks.join(nxt, "low", "left").select("a", F.coalesce("lower", "low").alias("low"), F.col("lower").isNotNull().alias("moved")), parts)
            moved = not jumped.where("moved").isEmpty()
            hooks = jumped.select("a", "low")
            if not moved:
                break
        to = hooks.select(F.col("a").alias("root"), F.col("low"))
        labels = checkpointed(labels.join(to, "root", "left").select("node", F.coalesce("low", "root").alias("root")), parts)
        of_a, of_b = hooks.select("a", F.col("low").alias("x")), hooks.select(F.col("a").alias("b"), F.col("low").alias("y"))
        pairs = checkpointed(
            pairs.join(of_a, "a", "left")
            .join(of_b, "b", "left")
            .select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
            .where("a <> b")
            .distinct(),
            parts,
        )
    return labels
