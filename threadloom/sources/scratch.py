"""Working tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir; below a folder of this machine only where that is unset, as in tests."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not shared and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not shared:
        shared = _OWN.setdefault(sc.applicationId, "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write df once and read it back: loops read tables instead of growing a plan, and lost executors cost no recomputation."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joinable(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """A broadcast of df where it has been counted to be small; else the join shuffles, and AQE splits skew."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
