"""Connected components of a link table by alternating star contraction; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """Hang every node's larger (or, in small stars, smaller) neighbours on its least neighbour."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    out = both.join(least, "a").select("a", "b", "low")
    if small:
        hung = out.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b")))
    else:
        hung = out.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return hung.where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    """Number and checksum of the links; stars that are complete do not change."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the least node of its component.

    The number of rounds grows with the logarithm of the longest chain. Each round is written to the shared folder.
    """
    links = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(links)
    while before[0]:
        links = cut_lineage(_stars(_stars(links, False), True))
        state = _state(links)
        if state == before:
            break
        before = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
