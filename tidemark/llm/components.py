"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import settle


def _mark(links: DataFrame) -> tuple:
    """Number and checksum of the links; an exclusive or cannot overflow, however many there are."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node among it and its neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these. ``a`` < ``b`` in every link."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of a frame of links ``(a, b)``; the root is the smallest node that can be reached.

    The number of rounds grows with the logarithm of the longest path. Every round is written to the shared folder, so
    a lost executor costs no more than its round. A hub's links are summed before they move and joined back, where
    Spark may split them. Links of a node to itself and null ends are ignored; repeated links count once.
    """
    ordered = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = settle(ordered, "links")
    mark = _mark(links)
    while mark[0]:
        links = settle(small_star(large_star(links)), "links")
        found = _mark(links)
        if found == mark:
            break
        mark = found
    # At the end every link leads from a root to a node of its component.
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
