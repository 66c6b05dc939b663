"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session. Only a local master may run without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lakestar-llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH")) if x)


class Scratch:
    """Writes frames as Parquet under one fresh folder and reads them back.

    Reading back cuts the lineage: a lost executor costs a re-read, and each
    job of an iterative operator starts from files.
    """

    def __init__(self, spark: SparkSession, name: str):
        reachable(spark)
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/lakestar-llm-{name}-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """``df``, written, in folders by the columns ``by`` if any, and read back."""
        self.n += 1
        path = f"{self.folder}/{self.n:03d}-{name}"
        df.write.partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def buckets(spark: SparkSession, rows: int, per_bucket: int) -> int:
    """A number of partitions that follows the data, never under the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_bucket))
