"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b), where root is the least node of its component.

    Large-star and small-star steps alternate until nothing changes; each writes its links, so lineage stays short, and
    a hub is only ever grouped with map-side minima or joined on its key. Self-links, doubled links and null ends are
    allowed: nodes of self-links are their own roots, links with a null end say nothing. No links give no rows.
    """
    ends = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    # From the greater to the lesser end.
    current = store(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    nodes = current.select(F.col("a").alias("node")).union(current.select("b")).distinct()
    state = _state(current)
    while state[0]:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("_m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
        stars = large.union(least.select("a", F.col("_m").alias("b"))).where(F.col("a") != F.col("b")).distinct()
        down = stars.groupBy("a").agg(F.min("b").alias("_m"))
        small = stars.join(down, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).union(down.select("a", F.col("_m").alias("b")))
        current = store(small.where(F.col("a") != F.col("b")).distinct(), "links")
        new = _state(current)
        if new == state:
            break
        state = new
    roots = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
