"""Connected components of a graph given as a table of links.

Alternating large-star and small-star steps: each replaces the links of a node
by links to its least neighbour, until every component is a star around its
least node.  Minima are aggregated map-side and joined back (a join that can
be split when a node is hot), so no neighbour list is ever gathered.  Each
round is cut by a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.session import cut_lineage


def _step(links: DataFrame, large: bool) -> DataFrame:
    """links: a > b.  Large: neighbours above u go to u's least neighbour; small: those below u, and u itself."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    # Cut, so that the join deals both sides anew and can split a hot node.
    least = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m")))
    out = both.join(least, F.col("a") == F.col("u"))
    moved = out.where(F.col("b") > F.col("a")) if large else out.where(F.col("b") != F.col("m"))
    pairs = moved.select(F.col("b").alias("x"), F.col("m").alias("y"))
    if not large:
        pairs = pairs.unionByName(least.select(F.col("u").alias("x"), F.col("m").alias("y")))
    return (
        pairs.where("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        .groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b")
    )


def _state(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())


def connected_components(links: DataFrame, most: int = 60) -> DataFrame:
    """node, root (the least node of its component) for every node of ``links`` (columns a, b; long)."""
    links = cut_lineage(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"))
    before = _state(links)
    for _ in range(most):
        links = cut_lineage(_step(_step(links, True), False))
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    roots = links.groupBy("b").agg(F.lit(1).alias("one")).select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
