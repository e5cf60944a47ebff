"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fareweather.llm import store

#: Edges for which a task of its own is worth while.
_TASK_ROWS = 20_000


def _large(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the least node it knows."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("m", "a"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    """Number and fingerprint of a set of edges."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 7))")).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes with an edge; component is the least node.

    ``edges`` has two long columns. Loops and repeated edges do not matter. Each
    round is written to the shared folder; the number of rounds grows with the
    logarithm of the longest chain.
    """
    first, second = edges.columns
    edges = (
        edges.where(F.col(first) != F.col(second))
        .select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
    )
    edges = store.written(edges, "edges")
    seen = _print(edges)
    while True:
        # The rounds only join edges, so tasks enough for the last ones are enough.
        turned = _small(_large(edges)).coalesce(max(seen[0] // _TASK_ROWS, 12))
        before, edges = edges, store.written(turned, "edges")
        store.drop(before)
        now = _print(edges)
        if now == seen:
            break
        seen = now
    node, root = F.col("a").alias("node"), F.col("b").alias("component")
    return edges.select(node, root).union(edges.select(root.alias("node"), root).distinct())
