"""Containment hierarchies: roots, transitive closure and what descendants hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphspark.storage import store


def roots(edges: DataFrame) -> DataFrame:
    """Parents of ``edges`` (parent, child) that are never a child; a null parent is none."""
    return edges.where(F.col("parent").isNotNull()).select(F.col("parent").alias("node")).distinct().join(edges.select(F.col("child").alias("node")), "node", "left_anti")


def only_root(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The one row of ``nodes`` (node, ...) that is never a child; an error if there is none or more than one."""
    found = nodes.join(edges.select(F.col("child").alias("node")).distinct(), "node", "left_anti")
    n = F.broadcast(found.agg(F.count("*").alias("_n")))
    checked = F.when(F.col("_n") == 1, F.col("_n")).otherwise(F.raise_error(F.concat(F.lit("expected exactly one root, found "), F.col("_n").cast("string"))))
    return n.where(checked == 1).join(found).drop("_n")


def closure(edges: DataFrame) -> DataFrame:
    """(ancestor, descendant) of ``edges`` (parent, child), however deep.

    Cycles are allowed; a node on one is its own ancestor. Null ends say nothing. Each round joins only the pairs that the
    round before added with the pairs known, so paths double in length; what is new is written to the shared folder, and
    rounds go on until there is none.
    """
    ends = edges.where(F.col("parent").isNotNull() & F.col("child").isNotNull())
    new = store(ends.select(F.col("parent").alias("ancestor"), F.col("child").alias("descendant")).distinct(), "pairs")
    parts = [new]
    while not new.isEmpty():
        known = parts[0]
        for p in parts[1:]:
            known = known.union(p)
        left, right = new.select("ancestor", F.col("descendant").alias("_m")), known.select(F.col("ancestor").alias("_m"), "descendant")
        back, front = known.select("ancestor", F.col("descendant").alias("_m")), new.select(F.col("ancestor").alias("_m"), "descendant")
        longer = left.join(right, "_m").select("ancestor", "descendant").union(back.join(front, "_m").select("ancestor", "descendant")).distinct()
        new = store(longer.join(known, ["ancestor", "descendant"], "left_anti"), "pairs")
        parts.append(new)
    out = parts[0]
    for p in parts[1:-1]:
        out = out.union(p)
    return out


def held_by_descendants(closed: DataFrame, members: DataFrame) -> DataFrame:
    """(ancestor, member): what the node itself or a descendant holds, of ``members`` (node, member)."""
    below = closed.join(members, F.col("descendant") == F.col("node")).select("ancestor", "member")
    return below.union(members.select(F.col("node").alias("ancestor"), "member")).distinct()


def containment(edges: DataFrame, nodes: DataFrame | None = None, predicate: str = "part_of") -> DataFrame:
    """``edges`` (parent, child) as facts s, p, o: the child is part of the parent.

    With ``nodes`` (node, iri) both ends are looked up; an edge without one of its nodes goes.
    """
    if nodes is not None:
        for end in ("parent", "child"):
            own = nodes.select(F.col("node").alias(end), F.col("iri").alias("_iri"))
            edges = edges.join(own, end).withColumn(end, F.col("_iri")).drop("_iri")
    return edges.select(F.col("child").alias("s"), F.lit(predicate).alias("p"), F.col("parent").alias("o"))
