import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
os.environ["PYTHONPATH"] = ":".join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[4]").config(map={"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.session.timeZone": "UTC"}).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s
