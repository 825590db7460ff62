"""Connected components of a graph given as pairs of long node ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.storage import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): every node of `links` (a, b) and one node chosen for its component.

    Local contraction: in every round each node moves to the neighbour, or itself, with
    the smallest hash under that round's seed, and links are carried over to the moved
    nodes. Hashes of another seed each round make chains shrink by a constant factor,
    so the rounds grow with the logarithm of the largest component. A node's minimum is
    combined before the shuffle; the joins read plain tables, so a hub's rows can be
    split over tasks. Null ends and links of a node with itself count for nothing.
    """
    links = stored(_proper(links), "links")
    moves: list[DataFrame] = []
    while not links.isEmpty():
        seed = F.lit(len(moves))
        to = lambda node: F.struct(F.xxhash64(node, seed).alias("hash"), F.col(node).alias("to"))
        near = F.array(
            *(
                F.struct(F.col(node).alias("node"), to(other).alias("near"))
                for node, other in (("a", "b"), ("b", "a"), ("a", "a"), ("b", "b"))
            )
        )
        nearest = links.select(F.inline(near)).groupBy("node").agg(F.min("near").alias("near"))
        moved = stored(nearest.select("node", F.col("near.to").alias("to")), "moves")
        moves.append(moved)
        links = (
            links.join(moved.toDF("a", "to_a"), "a")
            .join(moved.toDF("b", "to_b"), "b")
            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        )
        links = stored(_proper(links), "links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves.pop().toDF("node", "root")
    while moves:
        later = roots.toDF("to", "root")
        roots = moves.pop().join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
        roots = stored(roots, "roots")
    return roots


def _proper(links: DataFrame) -> DataFrame:
    pair = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pair.where("a < b").distinct()
