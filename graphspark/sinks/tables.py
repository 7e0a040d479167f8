"""Tab-separated tables, manifests and text reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, files: int | None = None) -> None:
    """``df`` with a header; arrays are joined with |, nulls are empty. ``files`` sets how many files there are."""
    plain = [F.concat_ws("|", c) if t.startswith("array") else F.col(c).cast("string") for c, t in df.dtypes]
    out = df.select(*[x.alias(c) for x, c in zip(plain, df.columns, strict=True)])
    (out.coalesce(files) if files else out).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)


def write_lines(df: DataFrame, path: str) -> None:
    """``df`` (ord, value) as one text file in order; for reports, which are small."""
    df.orderBy("ord").select("value").coalesce(1).write.mode("overwrite").text(path)


def with_files(networks: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """``networks`` (id, name) with file: the name made safe for a file system, the id where there is none, and an id's first
    eight characters behind it where the name is ``taken`` (file) or another network with a smaller id has it."""
    from graphspark.functions.identifiers import safe_file_name

    base = F.coalesce(F.nullif(safe_file_name(F.col("name")), F.lit("")), F.col("id"))
    rows = networks.withColumn("_base", base)
    first = rows.groupBy("_base").agg(F.min("id").alias("_first"))
    rows = rows.join(first, "_base")
    clash = F.col("id") != F.col("_first")
    if taken is not None:
        used = taken.select(F.regexp_replace("file", r"\.cx2$", "").alias("_base")).distinct().withColumn("_used", F.lit(True))
        rows = rows.join(used, "_base", "left")
        clash = clash | F.col("_used").isNotNull()
    name = F.when(clash, F.concat("_base", F.lit("_"), F.left("id", F.lit(8)))).otherwise(F.col("_base"))
    return rows.select("id", "name", F.concat(name, F.lit(".cx2")).alias("file"))


def pending(ids: DataFrame, manifest: DataFrame, present: DataFrame) -> DataFrame:
    """The ``ids`` (id, ...) that are not both in the ``manifest`` (id, file) and ``present`` (file): what a resumed download
    still has to get."""
    done = manifest.join(present.select("file").distinct(), "file", "left_semi").select("id")
    return ids.join(done, "id", "left_anti")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """``manifest`` (id, file, name) as JSON lines, one entry a line, in place of what is there."""
    manifest.select("id", "file", "name").coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(id, file, name) of a manifest; none where there is no readable one."""
    schema = "id string, file string, name string"
    try:
        return spark.read.schema(schema).json(path).where(F.col("id").isNotNull())
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def describe(values: dict[str, object]) -> str:
    """One line of JSON for a log."""
    return json.dumps(values, sort_keys=True)
