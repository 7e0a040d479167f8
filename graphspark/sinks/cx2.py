"""Network files as one JSON array of aspects, in the order that readers expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The last aspect of every file.
STATUS = '{"status":[{"success":true}]}'


def quoted(text: Column) -> Column:
    """A string as JSON text."""
    return F.substr(F.to_json(F.array(text)), F.lit(2), F.length(F.to_json(F.array(text))) - 2)


def bag_json(bag: Column) -> Column:
    """An object from a map of names to JSON texts."""
    return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(bag), lambda e: F.concat(quoted(e["key"]), F.lit(":"), F.coalesce(e["value"], F.lit("null")))), ","), F.lit("}"))




def node_json() -> Column:
    return F.concat(F.lit('{"id":'), F.col("id").cast("string"), F.lit(',"v":'), bag_json(F.col("v")), F.lit("}"))


def edge_json() -> Column:
    ends = [x for k in ("s", "t") for x in (F.lit(f',"{k}":'), F.col(k).cast("string"))]
    return F.concat(F.lit('{"id":'), F.col("id").cast("string"), *ends, F.lit(',"v":'), bag_json(F.col("v")), F.lit("}"))


def place_json() -> Column:
    third = F.when(F.col("z").isNotNull(), F.concat(F.lit(',"z":'), F.col("z").cast("string"))).otherwise("")
    return F.concat(F.lit('{"node":'), F.col("node").cast("string"), F.lit(',"x":'), F.col("x").cast("string"), F.lit(',"y":'), F.col("y").cast("string"), third, F.lit("}"))


def document(aspects: list[tuple[str, DataFrame | str]], extra: dict[str, int] | None = None) -> DataFrame:
    """(section, ord, value): the lines of a file. ``aspects`` are (name, elements), elements a table (ord, json) or the JSON
    text of the whole aspect; a count of the elements of each goes in front, the status last.

    Lines are made side by side: each element is a line of its own with a comma where another follows, so that no task holds
    an aspect.
    """
    spark = next(df for _, df in aspects if not isinstance(df, str)).sparkSession
    rows: list[tuple[int, int, str]] = [(0, 0, '[{"CXVersion":"2.0","hasFragments":false},')]
    parts, counts = [], []
    for k, (name, elements) in enumerate(aspects, 2):
        if isinstance(elements, str):
            rows.append((k, 0, f'{{"{name}":{elements}}},'))
            counts.append((k, name, (extra or {}).get(name, 1)))
            continue
        rows += [(k, -1, f'{{"{name}":['), (k, 1 << 62, "]},")]
        counts.append((k, name, elements.count()))
        last = elements.agg(F.max("ord").alias("_last"))
        comma = F.when(F.col("ord") == F.col("_last"), "").otherwise(",")
        parts.append(elements.join(F.broadcast(last)).select(F.lit(k).alias("section"), F.col("ord").cast("long").alias("ord"), F.concat("json", comma).alias("value")))
    meta = ",".join(f'{{"name":"{name}","elementCount":{n}}}' for _, name, n in counts)
    rows += [(1, 0, f'{{"metaData":[{meta}]}},'), (len(aspects) + 2, 0, f"{STATUS}]")]
    out = spark.createDataFrame(rows, "section int, ord long, value string")
    for p in parts:
        out = out.union(p)
    return out


def write_document(lines: DataFrame, path: str) -> None:
    """Write the lines in order to one file in the folder ``path``; a file is one stream, the sort before it is not."""
    lines.orderBy("section", "ord").select("value").coalesce(1).write.mode("overwrite").text(path)
