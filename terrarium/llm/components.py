"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrarium.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (columns a, b of a type with an
    order); root is the smallest node reachable.

    Each round renames every node to its smallest neighbour (itself included)
    and drops the links that became loops.  The smallest node of a component
    is never renamed, and at least every second other node goes in a round, so
    the number of rounds grows with the logarithm of the longest path.  Hot
    nodes are reduced by map-side minimum and joined with skew splitting.
    Null ends are dropped; an empty table gives an empty result."""
    edges = stored(links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        names = stored(both.groupBy(F.col("a").alias("node"))
                       .agg(F.min("b").alias("least"))
                       .select("node", F.least("node", "least").alias("root")))
        levels.append(names)
        renamed = (edges
                   .join(names.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
                   .join(names.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
                   .filter(F.col("x") != F.col("y")))
        edges = stored(renamed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    found = levels[-1]
    for names in reversed(levels[:-1]):
        later = found.select(F.col("node").alias("root"), F.col("root").alias("last"))
        found = (names.join(later, "root", "left")
                 .select("node", F.coalesce("last", "root").alias("root")))
    return found
