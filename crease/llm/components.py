"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crease.llm.common import cut


def _roots(pointers: DataFrame) -> DataFrame:
    """(id, to) followed to the end: every pointer leads to a smaller id or to itself."""
    while True:
        on = pointers.select(F.col("id").alias("to"), F.col("to").alias("further"))
        longer = cut(pointers.join(on, "to", "left").select("id", F.coalesce("further", "to").alias("next"), "to"))
        pointers = longer.select("id", F.col("next").alias("to"))
        if longer.filter(F.col("next") != F.col("to")).isEmpty():
            return pointers


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, lbl): for every node the smallest id of those connected with it by the
    edges (a, b), whose ends are nodes.

    Every node points at its smallest neighbour, or itself; pointers are followed to
    their ends; edges then link the ends, equal ones once, and the next round has
    those only.  Each round at least halves the nodes of a component that is not
    done, and a star of any size is done after one.
    """
    left = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(F.col("a") != F.col("b")).distinct())
    labels = nodes.select("id", F.col("id").alias("lbl"))
    while not left.isEmpty():
        least = left.select(F.col("b").alias("id"), F.col("a").alias("to")) \
            .unionAll(left.select(F.col("a").alias("id"), F.col("a").alias("to"))).groupBy("id").agg(F.min("to").alias("to"))
        ends = _roots(cut(least))
        first, second = ends.select(F.col("id").alias("a"), F.col("to").alias("x")), ends.select(F.col("id").alias("b"), F.col("to").alias("y"))
        labels = cut(labels.join(ends.select(F.col("id").alias("lbl"), "to"), "lbl", "left").select("id", F.coalesce("to", "lbl").alias("lbl")))
        left = cut(left.join(first, "a").select("x", "b").distinct().join(second, "b").filter(F.col("x") != F.col("y"))
                   .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return labels
