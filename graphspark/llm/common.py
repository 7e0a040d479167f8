"""What the corpus operators share: the shared folder, written intermediate tables, row identity."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch.
BATCH_ROWS = 1000
#: A key is hot that has more than one row in so many, and more than so many rows; there are fewer than ``HOT`` such keys.
HOT, HOT_LEAST = 1000, 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A local session that names none, as in tests, gets a temporary folder of this machine; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='graphspark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """Rows that a Python worker gets at once are kept few, as whole texts are long; a setting of the session stands."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) in (None, "10000"):
        spark.conf.set(key, BATCH_ROWS)


def store(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hot_keys(counts: DataFrame, key: str, total: int) -> DataFrame:
    """Of ``counts`` (key, _n) over ``total`` rows the keys of more than one row in ``HOT``, so fewer than ``HOT`` of them, and
    _parts: among how many parts such a key's rows are to be dealt."""
    limit = max(HOT_LEAST, total // HOT)
    return store(counts.where(F.col("_n") > limit).select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_parts")), "hot")


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, by: list[str]) -> DataFrame:
    """The inner join of ``left`` with ``right`` (unique keys): rows of a hot key are dealt by the hash of ``by`` among as many
    parts as ``hot`` says, each with a copy of the key's row, so no key's rows all meet in one task."""
    part = F.coalesce(F.pmod(F.xxhash64(*by), F.col("_parts")), F.lit(0)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    one = left.join(F.broadcast(hot), key, "left").withColumn("_part", part).drop("_parts")
    two = right.join(F.broadcast(hot), key, "left").withColumn("_part", copies).drop("_parts")
    return one.join(two, [key, "_part"]).drop("_part")


def text_digest(text: Column) -> Column:
    """128 bits that stand for a text, as a binary; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of ``sf_dir``. Python workers that are started from now on find this package where the driver found it."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [env.get("PYTHONPATH"), root]))
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
