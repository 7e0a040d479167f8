"""Selection on scored networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def core_backbone(edges: DataFrame, ends: list[str], score: str, order: list[str], floor: float) -> DataFrame:
    """Edges of at least ``floor`` (role core), and of the others each end's best (role backbone), earliest on ties.

    ``order`` must tell edges apart; nulls are its least values. Each end's best is an aggregate with map-side combine that
    carries the edge's order, and an edge is compared with the best of its own ends, so no table of winners is broadcast.
    Edges of a null end have no best there; a null score is neither core nor the best of any end.
    """
    place = F.struct(*[x for o in order for x in (F.col(o).isNotNull(), F.col(o))])
    out = edges.withColumn("_place", place)
    wins: Column = F.lit(False)
    for k, end in enumerate(ends):
        # The greatest score, and of its edges the least place.
        top = out.where(F.col(score).isNotNull() & F.col(end).isNotNull()).groupBy(F.col(end).alias(f"_e{k}")).agg(
            F.min_by("_place", F.struct(-F.col(score), F.col("_place"))).alias(f"_b{k}")
        )
        out = out.join(top, F.col(end) == F.col(f"_e{k}"), "left").drop(f"_e{k}")
        wins = wins | F.coalesce(F.col(f"_b{k}") == F.col("_place"), F.lit(False))
    role = F.when(F.col(score) >= floor, "core").when(wins, "backbone")
    return out.withColumn("role", role).where(F.col("role").isNotNull()).drop("_place", *[f"_b{k}" for k in range(len(ends))])


def without_payload(systems: DataFrame, size: str, cutoff: int) -> DataFrame:
    """The systems of at least ``cutoff``, which emit no members and no associations; a null size is none of either."""
    return systems.where(F.col(size) >= cutoff)


def with_payload(systems: DataFrame, size: str, cutoff: int) -> DataFrame:
    if cutoff < 1:
        raise ValueError("a cutoff must be at least 1")
    return systems.where(F.col(size) < cutoff)


def of_types(df: DataFrame, column: str, types: list[str]) -> DataFrame:
    """Rows whose ``column`` is one of ``types`` in any case; null is none."""
    return df.where(F.lower(column).isin([t.lower() for t in types]))


def without_flags(df: DataFrame, column: str, flags: list[str]) -> DataFrame:
    """Rows whose ``column`` is none of ``flags``; a row without a flag stays."""
    return df.where(F.coalesce(~F.col(column).isin(flags), F.lit(True)))


def significant(df: DataFrame, p_value: str, level: float = 0.05) -> DataFrame:
    """Rows with a p-value below ``level``; a null one is not."""
    return df.where(F.col(p_value).isNotNull() & (F.col(p_value) < level))


def top_groups(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The ``most`` largest groups: keys and n, more first and then by key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys).limit(most)
