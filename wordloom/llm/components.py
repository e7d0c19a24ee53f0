"""Connected components of a graph given by its edges, as joins and aggregates.

Large-star and small-star rounds (Kiveris et al. 2014): every round hangs the neighbours of
a node on their smallest one, until the edges are stars. A node with very many edges is a hot
key of a join only; the smallest neighbour is combined before it is shuffled, and stored, so
that both sides of the join are plain shuffles whose partitions Spark splits. Every round is
stored too, so no round repeats an earlier one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordloom.llm.common import stored


def _print(edges: DataFrame) -> tuple:
    """Tells whether a round changed anything: number of edges and a sum over them."""
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs on the smallest of them and the node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = stored(least.select("a", F.least("a", "m").alias("m")), "least")
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the smallest of them."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    others = edges.join(least, "a").where(F.col("b") != F.col("m"))
    return least.select("a", F.col("m").alias("b")).unionByName(
        others.select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``) that is not the smallest of its
    component; the smallest is the root. Loops and repeated edges do not matter; no edges
    give no rows; a null end is no edge."""
    oriented = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = stored(oriented.distinct(), "edges")
    state = _print(edges)
    while True:
        edges = stored(_small(_large(edges)), "edges")
        now = _print(edges)
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
