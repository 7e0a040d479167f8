"""The folder that driver and executors share, and intermediate tables written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. A local session that names none, as in tests, gets a temporary folder;
    on a cluster, where executors would not see it, that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='graphspark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
