"""Deduplication and collapse with a stated order: the first row, value or declaration wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphspark.operators.positions import dense_ids

__all__ = ["canonical_digest", "collapse_by_direction", "content_first", "dense_ids", "first_list", "first_values", "pair_limit", "unordered"]


def first_values(df: DataFrame, key: str, attributes: list[str], order: list[str]) -> DataFrame:
    """One row a key: of each attribute the first value in order that is not null."""
    place = F.struct(*order)
    return df.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in attributes])


def first_list(df: DataFrame, keys: list[str], item: str, order: list[str], out: str) -> DataFrame:
    """keys and ``out``: the distinct items of each key in the order of their first places.

    An item's first place is an aggregate, so what is gathered for a key is bounded by its distinct items.
    """
    places = df.groupBy(*keys, item).agg(F.min(F.struct(*order)).alias("_at"))
    ordered = F.array_sort(F.collect_list(F.struct("_at", F.col(item).alias("_item"))))
    return places.groupBy(*keys).agg(F.transform(ordered, lambda x: x["_item"]).alias(out))


def canonical_digest(values: Column) -> Column:
    """SHA-1 of a variant's, map's or struct's JSON; objects of variants are written with sorted names, so their order in the
    source does not count."""
    return F.sha1(F.to_json(values))


def content_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row, by ``order``, of those that agree in ``keys``, nulls included; the choice is an aggregate with map-side
    combine, not a sort of whole rows."""
    signature = canonical_digest(F.struct(*keys))
    picked = df.groupBy(signature.alias("_s")).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r"))
    return picked.select("_r.*")


def unordered(a: str | Column, b: str | Column) -> list[Column]:
    return [F.least(a, b).alias("low"), F.greatest(a, b).alias("high")]


def pair_limit(edges: DataFrame, source: str, target: str, most: int) -> DataFrame:
    """Pairs that have more than ``most`` edges: a check that should be empty after a collapse."""
    return edges.groupBy(*unordered(source, target)).agg(F.count("*").alias("n")).where(F.col("n") > most)


def collapse_by_direction(edges: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each pair and direction: s, t (those of the representative), pair_pos, place, edge (the representative's
    pos), found (its items in order, as structs), single.

    ``edges`` are (pos, s, t) and ``items`` (pos, i, item, ds, dt): the evidence of an edge in order, and the nodes that each
    item names, null where they are unknown. Edges of one unordered pair are taken together. A pair with one edge stays as it
    is. Else each item falls to its own direction, unknown ones to that of the pair's first edge, and an edge without items
    keeps the first edge's direction alive. A direction is represented by the edge that brings it up first; equal items
    count once. Pairs come in the order of their first edges, directions in that of their first items.
    """
    pairs = edges.withColumns({"_low": F.least("s", "t"), "_high": F.greatest("s", "t")})
    first = pairs.groupBy("_low", "_high").agg(F.min("pos").alias("pair_pos"), F.count("*").alias("_n"), F.min_by(F.struct("s", "t"), "pos").alias("_default"))
    placed = pairs.join(first, ["_low", "_high"])
    # An edge without items stands as an item that says nothing, in the place before a first one.
    each = placed.where("_n > 1").join(items, "pos", "left").select(
        "_low", "_high", "pair_pos", "pos", F.coalesce("i", F.lit(-1)).alias("i"), "item",
        F.when(F.col("ds").isNotNull() & F.col("dt").isNotNull(), F.struct(F.col("ds").alias("s"), F.col("dt").alias("t"))).otherwise(F.col("_default")).alias("_way"),
    )
    at = F.struct("pos", "i")
    buckets = each.groupBy("_low", "_high", "pair_pos", "_way").agg(F.min(at).alias("place"))
    once = each.where(F.col("item").isNotNull()).groupBy("_low", "_high", "_way", "item").agg(F.min(at).alias("_at"))
    lists = once.groupBy("_low", "_high", "_way").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "item"))), lambda x: x["item"]).alias("found"))
    many = buckets.join(lists, ["_low", "_high", "_way"], "left").withColumn("edge", F.col("place.pos"))
    many = many.join(edges.select(F.col("pos").alias("edge"), "s", "t"), "edge").select("s", "t", "pair_pos", "place", "edge", "found", F.lit(False).alias("single"))
    kind = dict(many.dtypes)
    one = placed.where("_n = 1").select("s", "t", "pair_pos", F.struct("pos", F.lit(-1).alias("i")).cast(kind["place"]).alias("place"), F.col("pos").alias("edge"), F.lit(None).cast(kind["found"]).alias("found"), F.lit(True).alias("single"))
    return many.unionByName(one)
