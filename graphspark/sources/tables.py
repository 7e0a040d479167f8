"""Delimited tables, id lists and landed lookup snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A tab-separated table with a header; with ``schema`` its columns are taken by position and typed."""
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
    return reader.csv(path, schema=schema) if schema else reader.csv(path)


def dimension(df: DataFrame, key: str, filled: str | None = None) -> DataFrame:
    """``df`` with one row a key, the last in file order; rows whose ``filled`` column is null or empty are left out first.

    Rows keep their place in the files, so the table should be as read; the choice is an aggregate, no sort.
    """
    rows = df.withColumn("_at", F.monotonically_increasing_id())
    if filled:
        rows = rows.where(F.coalesce(F.col(filled).cast("string") != "", F.lit(False)))
    return rows.groupBy(key).agg(F.max_by(F.struct(*df.columns), "_at").alias("_r")).select("_r.*")


def read_commented(spark: SparkSession, path: str, columns: list[str], needed: int, requires: dict[str, str] | None = None) -> DataFrame:
    """A tab-separated file of ``columns`` without types: blank lines, lines that begin with # and a header line that begins
    with the first column's name are skipped, fields are trimmed, absent ones are empty.

    A line of fewer than ``needed`` fields is an error when it is read, as is a filled column of ``requires`` whose other
    column is empty.
    """
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    parts = lines.select("value", F.split("value", "\t", -1).alias("_f")).where(F.get("_f", F.lit(0)) != columns[0])
    parts = parts.withColumn("_f", F.when(F.size("_f") >= needed, F.col("_f")).otherwise(F.raise_error(F.concat(F.lit(f"expected {needed} fields or more: "), "value"))))
    out = parts.select(*[F.trim(F.coalesce(F.get("_f", F.lit(k)), F.lit(""))).alias(c) for k, c in enumerate(columns)])
    for c, other in (requires or {}).items():
        out = out.withColumn(c, F.when((F.col(c) == "") | (F.col(other) != ""), F.col(c)).otherwise(F.raise_error(F.concat(F.lit(f"{c} without {other}: "), F.col(c)))))
    return out


def read_ids(spark: SparkSession, path: str, header: str = "network_id") -> DataFrame:
    """(id, ord): the distinct ids of a one-column list, first places in file order; quotes, blanks and headers go."""
    value = F.trim(F.regexp_replace(F.trim("value"), '^"+|"+$', ""))
    lines = spark.read.text(path).select(value.alias("id"), F.monotonically_increasing_id().alias("ord"))
    return lines.where((F.col("id") != "") & (F.lower("id") != header.lower())).groupBy("id").agg(F.min("ord").alias("ord"))


def read_snapshot(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key, value): the entries of JSON files that are each one object; values are parsed as ``value`` (a DDL type)."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "value"))


def looked_up(df: DataFrame, cache: DataFrame, key: str, out: str, offline: bool = True) -> DataFrame:
    """``df`` with ``out`` from ``cache`` (key, value). A key that the cache lacks is an error when ``offline``, else null."""
    found = df.join(cache.select(F.col("key").alias("_k"), F.col("value").alias("_v")), F.col(key) == F.col("_k"), "left")
    missing = F.raise_error(F.concat(F.lit("not cached: "), F.col(key).cast("string"))) if offline else F.lit(None)
    return found.withColumn(out, F.when(F.col("_k").isNotNull() | F.col(key).isNull(), F.col("_v")).otherwise(missing)).drop("_k", "_v")


def registry_stems(snapshot: DataFrame) -> DataFrame:
    """(prefix, stem) of registry records (key, value with uri_format): formats that end in $1 give a stem, others none."""
    form = F.col("value.uri_format")
    return snapshot.where(form.endswith("$1")).select(F.col("key").alias("prefix"), F.substr(form, F.lit(1), F.length(form) - 2).alias("stem"))
