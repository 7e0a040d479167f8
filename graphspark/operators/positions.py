"""Positions in a total order, and what is computed from them: dense ids, batches, layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphspark.storage import store

def dense_positions(df: DataFrame, order: list[str | Column], out: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with ``out``: 0, 1, 2, ... by ``order``, which should be total; nulls come first.

    Rows are dealt by range and sorted within, and the ranges' sizes (``ranges`` rows; as many as the session's shuffle
    partitions if not given) are summed up: no task ever sees the whole table. The dealt rows are written to the shared
    folder, so that a second pass sees the same ranges.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # The lower 33 bits count the rows of a task, the upper ones number the tasks.
    numbered = store(dealt.withColumn("_at", F.monotonically_increasing_id()), "positions")
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))
    return numbered.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(out, F.col("_before") + row).drop("_at", "_part", "_before")


def dense_ids(df: DataFrame, key: str, order: str, ranges: int | None = None) -> DataFrame:
    """key and id from 0 by first appearance in ``order``; a null key is a key, nulls of the order come first."""
    first = df.groupBy(key).agg(F.min(order).alias("_first"))
    return dense_positions(first, ["_first", key], "id", ranges).select(key, "id")


def batches(df: DataFrame, order: list[str | Column], size: int) -> DataFrame:
    """``df`` with batch: 0 for the first ``size`` rows by ``order``, and so on."""
    return dense_positions(df, order, "_p").withColumn("batch", F.floor(F.col("_p") / size).cast("bigint")).drop("_p")


def ring_layout(df: DataFrame, order: list[str | Column], radius: float | Column = 1.0, centre: tuple = (0.0, 0.0)) -> DataFrame:
    """``df`` with x and y: even places on a circle by ``order``, beginning at angle 0."""
    placed = dense_positions(df, order, "_p")
    n = placed.agg(F.count("*").alias("_n"))
    angle = 2 * F.pi() * F.col("_p") / F.col("_n")
    x, y = (F.lit(c) if not isinstance(c, Column) else c for c in centre)
    radius = radius if isinstance(radius, Column) else F.lit(float(radius))
    return placed.join(F.broadcast(n)).withColumns({"x": x + radius * F.cos(angle), "y": y + radius * F.sin(angle)}).drop("_p", "_n")


def grid_layout(df: DataFrame, order: list[str | Column], step: float = 1.0, corner: tuple = (0.0, 0.0)) -> DataFrame:
    """``df`` with x and y: row by row on a grid of as many columns as the whole root of the number of rows, at least one."""
    placed = dense_positions(df, order, "_p")
    n = placed.agg(F.greatest(F.lit(1), F.floor(F.sqrt(F.count("*"))).cast("bigint")).alias("_c"))
    x, y = (F.lit(c) if not isinstance(c, Column) else c for c in corner)
    return placed.join(F.broadcast(n)).withColumns({"x": x + F.col("_p") % F.col("_c") * step, "y": y + F.floor(F.col("_p") / F.col("_c")) * step}).drop("_p", "_c")
