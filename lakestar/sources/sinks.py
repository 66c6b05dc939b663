"""Layer writer: every table of a run goes to a run-scoped folder; the run is
published (made the one readers see) only after its checks pass.

Row counts are taken while writing (``DataFrame.observe``), not by a second pass.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from dataclasses import dataclass, field

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.operators.joins import write_table

FACT_TABLES = {("gold", t) for t in schemas.FACTS}
PUBLISHED = {"silver": [*schemas.SILVER, *schemas.LOOKUPS], "gold": list(schemas.GOLD),
             "audit": ["rejected_rows", "fact_rejects", "dq_results", "load_audit"]}


@dataclass
class WriteStat:
    layer: str
    table: str
    rows: int
    seconds: float
    path: str
    metrics: dict = field(default_factory=dict)


@dataclass
class LayerWriter:
    spark: SparkSession
    root: str
    run_id: str = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
                        + "-" + uuid.uuid4().hex[:6])
    fmt: str = "parquet"
    checked: bool = True
    stats: list[WriteStat] = field(default_factory=list)
    observed: dict[tuple[str, str], dict] = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/runs/{self.run_id}/{layer}/{table}"

    def __call__(self, layer: str, table: str, df: DataFrame, mode: str = "overwrite",
                 metrics: list | None = None, layout: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` and return it read back (lineage cut, size known to Catalyst).

        ``metrics`` are extra aggregate Columns observed during the same write; ``kept_rows`` among them is
        what the load audit counts. ``layout``: partition columns. Without ``checked``, FK-checked raw tables are not
        written: without rejects only their silver table reads them.
        """
        if layer == "bronze" and not self.checked:
            return df
        path = self.path(layer, table)
        obs = Observation(f"{layer}_{table}_{uuid.uuid4().hex[:6]}")
        t0 = time.perf_counter()
        out = write_table(df, path, obs, self.fmt, mode, metrics, layout)
        got = dict(obs.get)
        rows = int(got.get("kept_rows", got["rows"]))
        with self._lock:
            self.stats.append(WriteStat(layer, table, rows, time.perf_counter() - t0, path, got))
            self.observed[layer, table] = got
        return out

    def local_frame(self, data: dict, ddl: str) -> DataFrame:
        """A small frame from driver-side values (one row per table), via Arrow."""
        return self.spark.createDataFrame(pd.DataFrame(data), ddl)

    def stats_frame(self) -> DataFrame:
        """Load audit: one row per written table (bounded by the number of tables)."""
        pdf = pd.DataFrame({"layer": [s.layer for s in self.stats], "table_name": [s.table for s in self.stats],
                            "rows": [s.rows for s in self.stats], "seconds": [float(s.seconds) for s in self.stats],
                            "run_id": [self.run_id] * len(self.stats)})
        return self.spark.createDataFrame(pdf, "layer string, table_name string, rows long, seconds double, "
                                               "run_id string")

    def publish(self) -> None:
        """Point readers at this run: one more row of the pointer table, the latest of which counts.

        Earlier pointers stay, so a crash while this one is written leaves readers with the last good run.
        """
        ptr = self.spark.range(1).select(F.lit(self.run_id).alias("run_id"),
                                         F.localtimestamp().cast("timestamp_ntz").alias("published_at"))
        ptr.coalesce(1).write.mode("append").parquet(f"{self.root.rstrip('/')}/published")


def published_run(spark: SparkSession, root: str) -> str:
    pointers = spark.read.parquet(f"{root.rstrip('/')}/published")
    return pointers.orderBy(F.desc("published_at"), F.desc("run_id")).first()["run_id"]


def read_facts(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A fact table's rows with ``fact_month``, from its (kept, month) partitions."""
    star = spark.read.schema(schemas.star_schema(table)).parquet(path)
    return star.where("kept").select(*schemas.GOLD[table].schema.names, "fact_month")


def read_published(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """Files of the published run."""
    run = published_run(spark, root)
    path = f"{root.rstrip('/')}/runs/{run}/{layer}/{table}"
    return read_facts(spark, path, table) if (layer, table) in FACT_TABLES else spark.read.parquet(path)


def register_tables(spark: SparkSession, root: str, layers: dict[str, list[str]] | None = None) -> list[str]:
    """Make the published run's tables known as ``layer.table``, so that SQL text runs on them.

    Each layer is a namespace under ``root``; a table is a view over the run's files, replaced when a later
    run is published. Returns the names.
    """
    run = published_run(spark, root)
    names = []
    for layer, tables in (layers or PUBLISHED).items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root.rstrip('/')}/namespaces/{layer}'")
        for table in tables:
            path = f"{root.rstrip('/')}/runs/{run}/{layer}/{table}"
            try:
                schema = read_published(spark, root, layer, table).schema
            except AnalysisException as e:
                if "PATH_NOT_FOUND" in str(e):
                    continue            # not part of this run (the other domain's tables)
                raise
            spark.sql(f"DROP VIEW IF EXISTS {layer}.{table}")
            columns, source = ", ".join(f"`{c}`" for c in schema.names), f"parquet.`{path}`"
            if (layer, table) in FACT_TABLES:
                if not read_facts(spark, path, table).inputFiles():        # a partitioned table without rows has no files
                    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
                    source = "range(0)"
                else:
                    source += " WHERE kept = 'true'"     # partition values found in paths are text here
            spark.sql(f"CREATE VIEW {layer}.{table} AS SELECT {columns} FROM {source}")
            names.append(f"{layer}.{table}")
    return names


def overwrite_months(star: DataFrame, path: str, table: str, months: list[int]) -> None:
    """Replace those months of a written fact table, and nothing else (dynamic partition overwrite).

    A (kept, month) partition that has no rows any more is removed.
    """
    spark = star.sparkSession
    mine = F.col("fact_month").isin([int(m) for m in months])
    before = spark.read.schema(schemas.star_schema(table)).parquet(path).where(mine).select(*schemas.LAYOUT).distinct().collect()
    obs = Observation(f"months_{uuid.uuid4().hex[:8]}")
    write_table(star.where(mine), path, obs, metrics=[F.collect_set(F.struct(*schemas.LAYOUT)).alias("now")], layout=schemas.LAYOUT)
    now = {(r["kept"], r["fact_month"]) for r in obs.get["now"]}     # at most two a month of the calendar
    for kept, month in {(r["kept"], r["fact_month"]) for r in before} - now:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/kept={str(kept).lower()}/fact_month={month}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def append_history(spark: SparkSession, root: str, run_id: str, loads: DataFrame, checks: DataFrame | None = None) -> None:
    """Append a run's load counts and check results to the histories of all runs."""
    at = F.localtimestamp().cast("timestamp_ntz")
    for name, df in (("loads", loads), ("checks", checks)):
        if df is not None:
            rows = df.drop("run_id").select(F.lit(run_id).alias("run_id"), at.alias("run_at"), "*")
            rows.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/history/{name}")


def load_history(spark: SparkSession, root: str) -> DataFrame:
    """Every run's row counts beside those of the run before, per table."""
    by_run = Window.partitionBy("layer", "table_name").orderBy("run_at", "run_id")
    runs = spark.read.parquet(f"{root.rstrip('/')}/history/loads")
    before = F.lag("rows").over(by_run)
    return runs.select("run_id", "run_at", "layer", "table_name", "rows", before.alias("rows_before"),
                       (F.col("rows") - before).alias("change"))


def check_history(spark: SparkSession, root: str) -> DataFrame:
    """Every run's check findings beside those of the run before, per check and column."""
    by_run = Window.partitionBy("check_name", "table_name", "column_name").orderBy("run_at", "run_id")
    runs = spark.read.parquet(f"{root.rstrip('/')}/history/checks")
    return runs.select("*", F.lag("violations").over(by_run).alias("violations_before"))


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows to an existing table (the reference's append load)."""
    df.write.mode("append").format(fmt).save(path)
