"""Written intermediate tables and FK existence tests.

Finished tables are written and read back, so Catalyst knows their file sizes and broadcasts a side only under
``spark.sql.autoBroadcastJoinThreshold``; every other join is a shuffled join, which AQE re-plans and splits when
one key is hot. A side that grows with the input is ``shuffled`` whatever its files take: compressed keys are a
fifteenth of the hash table that a broadcast would build on the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakestar.session import ensure_checkpoint_dir


def write_table(df: DataFrame, path: str, obs: Observation, fmt: str = "parquet", mode: str = "overwrite",
                metrics: list | None = None, layout: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` (counting rows while writing) and return it read back.

    ``layout``: partition columns. Rows are gathered by them first, in pieces of AQE's advisory size: a
    small partition becomes one file, a hot one several.
    """
    if layout:
        df = df.hint("rebalance", *[F.col(c) for c in layout])
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *(metrics or []))
    writer = observed.write.mode(mode).format(fmt)
    if layout:
        writer = writer.partitionBy(*layout).option("partitionOverwriteMode", "dynamic" if mode == "overwrite" else "static")
    writer.save(path)
    reader = df.sparkSession.read.format(fmt)
    return (reader.schema(df.schema) if layout else reader).load(path)  # a partitioned table may have no file at all


def materialize(df: DataFrame, metrics: list | None = None, layout: tuple[str, ...] = (),
                observed: dict | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    One job (a reliable ``checkpoint()`` computes the plan twice unless cached),
    lineage is cut, a lost executor only costs re-reading files, and the
    read-back carries real file sizes for Catalyst's broadcast threshold. ``metrics`` are
    observed during the write and put into ``observed``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestar-tables/{uuid.uuid4().hex}"
    if not metrics and not layout:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    obs = Observation(f"t{uuid.uuid4().hex[:10]}")
    out = write_table(df, path, obs, metrics=metrics, layout=layout)
    if observed is not None:
        observed.update(obs.get)
    return out


def shuffled(df: DataFrame) -> DataFrame:
    """A join side with a row per user, subscription and the like: no broadcast, the driver's memory does not grow with it."""
    return df.hint("merge")


def semi(df: DataFrame, parent: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key exists in ``parent`` (no fan-out, no parent columns)."""
    return df.join(parent, on, "left_semi")


def anti(df: DataFrame, parent: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is missing from ``parent``."""
    return df.join(parent, on, "left_anti")
