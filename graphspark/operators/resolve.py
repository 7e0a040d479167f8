"""Resolution: endpoints, names and identifiers looked up in other tables, with their fallbacks and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; ``order`` must be total. A null key is a key. An aggregate with map-side combine."""
    return df.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def endpoints(edges: DataFrame, nodes: DataFrame, source: str, target: str, key: str, value: str, how: str = "inner") -> DataFrame:
    """``edges`` with source_value and target_value; an edge without one of its nodes goes, or with ``how`` left gets nulls."""
    n = nodes.select(F.col(key).alias("_id"), F.col(value).alias("_value"))
    for side, name in ((source, "source_value"), (target, "target_value")):
        edges = edges.join(n, F.col(side) == F.col("_id"), how).withColumnRenamed("_value", name).drop("_id")
    return edges


def unmapped(edges: DataFrame, nodes: DataFrame, source: str, target: str, key: str) -> DataFrame:
    """The edges that lack one of their nodes."""
    found = endpoints(edges, nodes.select(key, F.lit(True).alias("_there")).distinct(), source, target, key, "_there", "left")
    return found.where(F.col("source_value").isNull() | F.col("target_value").isNull()).drop("source_value", "target_value")


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, fallback: Column, out: str) -> DataFrame:
    """``df`` with ``out``: the value of ``key`` in ``table`` (key, value; unique keys), else the fallback."""
    t = table.select(F.col(table.columns[0]).alias("_key"), F.col(table.columns[1]).alias("_found"))
    return df.join(t, F.col(key) == F.col("_key"), "left").withColumn(out, F.coalesce("_found", fallback)).drop("_key", "_found")


def conditional_lookup(df: DataFrame, table: DataFrame, key: str, applies: Column, out: str) -> DataFrame:
    """``df`` with ``out`` from ``table`` (key, value; unique keys), only for rows for which ``applies`` is true; else null."""
    t = table.select(F.col(table.columns[0]).alias("_key"), F.col(table.columns[1]).alias(out))
    return df.drop(out).join(t, F.coalesce(applies, F.lit(False)) & (F.col(key) == F.col("_key")), "left").drop("_key")


def two_key_lookup(df: DataFrame, table: DataFrame, keys: list[str], out: str) -> DataFrame:
    """``df`` with ``out``: the value in ``table`` (key, value; unique keys) of the first of ``keys`` that has one."""
    for k, key in enumerate(keys):
        t = table.select(F.col(table.columns[0]).alias("_key"), F.col(table.columns[1]).alias(f"_v{k}"))
        df = df.join(t, F.col(key) == F.col("_key"), "left").drop("_key")
    return df.withColumn(out, F.coalesce(*[f"_v{k}" for k in range(len(keys))])).drop(*[f"_v{k}" for k in range(len(keys))])


def cascade(df: DataFrame, key: str, tiers: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """``df`` with resolved and route: the first tier (name, table of key and value, order) that has the key gives both.

    Of a key that a tier lists more than once the first value by the tier's order counts, and the route gets the ending
    _ambiguous. Null values are not listed. A tier's table is reduced to one row a key before the join.
    """
    picks = []
    for k, (name, table, order) in enumerate(tiers):
        own, value = table.columns[:2]
        t = table.where(F.col(value).isNotNull()).groupBy(F.col(own).alias(f"_k{k}")).agg(F.min_by(F.col(value), F.struct(*order)).alias("_v"), F.count("*").alias("_n"))
        t = t.select(f"_k{k}", F.struct(F.col("_v").alias("value"), F.concat(F.lit(name), F.when(F.col("_n") > 1, "_ambiguous").otherwise("")).alias("route")).alias(f"_s{k}"))
        df = df.join(t, F.col(key) == F.col(f"_k{k}"), "left").drop(f"_k{k}")
        picks.append(F.col(f"_s{k}"))
    best = F.coalesce(*picks)
    return df.withColumns({"resolved": best["value"], "route": F.coalesce(best["route"], F.lit("unresolved"))}).drop(*[f"_s{k}" for k in range(len(tiers))])


def rejects(df: DataFrame, table: DataFrame, key: str, other: str) -> DataFrame:
    """The rows of ``df`` whose key is not in ``table``."""
    return df.join(table.select(F.col(other).alias("_o")).distinct(), F.col(key) == F.col("_o"), "left_anti")


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each key of either side, with side: both, left or right."""
    a, b = left.select(key).distinct().withColumn("_a", F.lit(True)), right.select(key).distinct().withColumn("_b", F.lit(True))
    side = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "left").otherwise("right")
    return a.join(b, key, "full").select(key, side.alias("side"))


def members(df: DataFrame, array: str, table: DataFrame, keep: list[str], out: str) -> DataFrame:
    """``keep`` and ``out``: the values in ``table`` (key, value) of each row's array elements, in the order of the array;
    elements that the table lacks are left out, a row without any has an empty array. ``keep`` must tell rows apart."""
    t = table.select(F.col(table.columns[0]).alias("_key"), F.col(table.columns[1]).alias("_value"))
    each = df.select(*keep, F.posexplode_outer(array).alias("_i", "_key")).join(t, "_key", "left")
    pairs = F.array_sort(F.collect_list(F.when(F.col("_value").isNotNull(), F.struct("_i", "_value"))))
    return each.groupBy(*keep).agg(F.transform(pairs, lambda x: x["_value"]).alias(out))


def with_shares(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n and share: how many rows a group has, and what per cent of all that is; the total is one row."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_all"))
    return counts.join(F.broadcast(total)).select(*keys, "n", (100.0 * F.col("n") / F.col("_all")).alias("share"))


def disambiguated(df: DataFrame, name: str, key: Column, out: str) -> DataFrame:
    """``df`` with ``out``: the name, with _ and ``key`` behind it where more rows than one have it."""
    many = df.groupBy(F.col(name).alias("_name")).agg((F.count("*") > 1).alias("_many"))
    return df.join(many, F.col(name) == F.col("_name"), "left").withColumn(out, F.when(F.col("_many"), F.concat(F.col(name), F.lit("_"), key)).otherwise(F.col(name))).drop("_name", "_many")
