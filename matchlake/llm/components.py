"""Connected components of an edge table, by contraction in joins.

Each round hooks every node to its smallest neighbour, if that is smaller, and
replaces both ends of every edge by what they hooked to.  Local minima, about a third
of the nodes for ids in no order, are all that remains of a round, so the number of
rounds grows with the logarithm of the largest component.  Node ids should be hashes.
The only aggregation is a minimum by node, folded before its shuffle, so a node with
very many edges is no burden; tables between rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.text import Scratch, short_lived_shuffles


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for each end of an edge (a, b); root is the smallest id of the component."""
    flat = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    flat = scratch.write(f"{name}-edges-0", flat.dropDuplicates())
    rounds: list[DataFrame] = []
    while True:
        with short_lived_shuffles(edges.sparkSession):
            if not flat.head(1):
                break
        number = len(rounds) + 1
        both = flat.unionByName(flat.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("node"), F.least("a", "to").alias("to"))
        hooks = scratch.write(f"{name}-hooks-{number}", hooks)
        rounds.append(hooks)
        moved = flat.join(hooks.toDF("a", "x"), "a").join(hooks.toDF("b", "y"), "b").where("x <> y")
        moved = moved.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).dropDuplicates()
        flat = scratch.write(f"{name}-edges-{number}", moved)
        scratch.drop(f"{name}-edges-{number - 1}")
    if not rounds:
        return flat.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # a node's root is what its hooks lead to, round by round; each round has but a part of the one before
    labels = rounds[0].withColumnRenamed("to", "root")
    for hooks in rounds[1:]:
        labels = labels.join(hooks.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    labels = scratch.write(f"{name}-labels", labels)
    scratch.drop(f"{name}-edges-{len(rounds)}", *(f"{name}-hooks-{n + 1}" for n in range(len(rounds))))
    return labels
