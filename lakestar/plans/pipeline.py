"""Full run: raw -> bronze -> silver -> gold, checks, publish.

The reference runs three scripts and carries on after failures; here a stage
failure raises, and the run becomes visible to readers only when every quality
check passes (tables are published together, not one by one).
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions.conform import as_text
from lakestar.operators import audit, quality
from lakestar.plans.build import Build
from lakestar.plans.rejects import rejected_rows, ticketing_rejects
from lakestar.sources.landing import land
from lakestar.sources.sinks import LayerWriter, append_history


@dataclass
class RunReport:
    run_id: str
    published: bool
    failed_checks: int
    seconds: dict[str, float]
    rows: dict[str, int]
    table_seconds: dict[str, float]


def quality_frames(b: Build) -> dict[str, DataFrame]:
    """Checks over the built silver and gold tables (plus lookups); nothing runs until they are written.

    Row-wise findings were observed while the tables were written; keys take one scan a table, foreign keys one
    shuffle a parent.
    """
    layers = [("silver", b.silver_tables(), schemas.SILVER), ("silver", b.lookups, schemas.LOOKUPS),
              ("gold", b.gold_tables(), schemas.GOLD)]
    keys = [f for prefix, tables, contracts in layers for f in quality.key_checks(tables, contracts, prefix)]
    observed = quality.observed_checks(b.spark, [
        (f"{prefix}.{n}", contracts[n], b.observed[prefix, n]) for prefix, tables, contracts in layers for n in tables])
    parents = {n: (f"silver.{n}", df) for n, df in {**b.silver_tables(), **b.lookups}.items()}
    gparents = {n: (f"gold.{n}", df) for n, df in b.gold_tables().items()}
    fks = (quality.fk_checks(b.silver_tables(), schemas.SILVER, "silver", parents)
           + quality.fk_checks(b.gold_tables(), schemas.GOLD, "gold", gparents))
    return {"pk": quality.union_all(keys), "fk": quality.union_all(fks), **observed}


# Tables whose inputs are all built by earlier waves; a wave's writes are
# submitted together (Spark runs concurrent jobs of one context side by side).
SILVER_WAVES = [["lookups", "locations"], ["users", "watchlist"], ["devices", "subscriptions"],
                ["payments", "viewing_activity"]]
GOLD_WAVES = [["dim_date", "dim_content", "dim_user"], ["fact_subscription_events", "fact_viewing_activity"]]


def build_waves(b: Build, waves: list[list[str]], parallel: bool = True) -> None:
    for wave in waves:
        if parallel and len(wave) > 1:
            with ThreadPoolExecutor(max_workers=len(wave)) as pool:
                list(pool.map(lambda attr: getattr(b, attr), wave))
        else:
            for attr in wave:
                getattr(b, attr)


def run(spark: SparkSession, raw: dict[str, DataFrame], root: str, as_of=None,
        publish: bool = True, run_id: str | None = None) -> RunReport:
    """Build and publish all layers. ``as_of``: the day that "active" is judged on; None is the current date.

    A raw table that is missing counts as empty.
    """
    w = LayerWriter(spark, root) if run_id is None else LayerWriter(spark, root, run_id)
    missing = [t for t in schemas.SUBSCRIPTION_TABLES if t not in raw]
    raw = raw | {t: spark.createDataFrame([], schemas.RAW[t]) for t in missing}
    secs: dict[str, float] = {}

    def land_one(item):
        """Land one raw table; its fingerprint is observed during the same write."""
        name, df = item
        landed = land(as_text(df))
        return name, w("bronze", name, landed, metrics=audit.fingerprint_metrics(landed))

    t = time.perf_counter()
    with ThreadPoolExecutor(max_workers=max(1, len(raw))) as pool:
        bronze = dict(pool.map(land_one, raw.items()))
    prints = [s for s in w.stats if s.layer == "bronze"]
    w("audit", "bronze_fingerprints", w.local_frame(
        {"table_name": [s.table for s in prints], "row_count": [int(s.metrics["row_count"]) for s in prints],
         "fingerprint": [audit.fingerprint_from_metrics(s.metrics) for s in prints]},
        "table_name string, row_count long, fingerprint string"))
    secs["bronze"] = time.perf_counter() - t

    b = Build(spark, bronze, as_of, sink=w)
    t = time.perf_counter()
    build_waves(b, SILVER_WAVES)
    secs["silver"] = time.perf_counter() - t

    # reject records need only silver: written in the background while gold builds
    background = ThreadPoolExecutor(max_workers=1)
    rej = background.submit(lambda: w("audit", "rejected_rows", rejected_rows(b)))
    t = time.perf_counter()
    build_waves(b, GOLD_WAVES)
    secs["gold"] = time.perf_counter() - t

    t = time.perf_counter()
    lost = background.submit(lambda: w("audit", "fact_rejects", b.fact_rejects))
    q = quality_frames(b)
    dq = w("audit", "dq_results", quality.dq_results(q["pk"], q["not_null"], q["fk"], q["varchar"]))
    rej.result()
    lost.result()
    background.shutdown()
    failed = dq.where(~F.col("passed")).count()
    secs["checks"] = time.perf_counter() - t

    loads = w("audit", "load_audit", w.stats_frame())
    append_history(spark, root, w.run_id, loads, dq)
    ok = failed == 0
    if ok and publish:
        w.publish()
    return RunReport(w.run_id, ok and publish, failed, secs,
                     {f"{s.layer}.{s.table}": s.rows for s in w.stats},
                     {f"{s.layer}.{s.table}": round(s.seconds, 3) for s in w.stats})


def run_ticketing(spark: SparkSession, raw: dict[str, DataFrame], root: str,
                  publish: bool = True) -> RunReport:
    """Documented ticketing domain: silver rules, then event sales, daily metrics, campaign ROI.

    Each silver table is written once and read back before the KPIs read it;
    independent tables of a wave are written together.
    """
    from lakestar.plans.kpis import Ticketing

    w = LayerWriter(spark, root)
    secs: dict[str, float] = {}
    k = Ticketing(raw, sink=w)
    t = time.perf_counter()
    first = ["venues", "events", "customers"] + (["artists"] if "artists" in raw else [])
    build_waves(k, [first, ["tickets"], ["checkins", "refunds", "campaigns"]])
    secs["silver"] = time.perf_counter() - t
    t = time.perf_counter()
    build_waves(k, [["event_sales", "daily_metrics", "campaign_roi"]])
    secs["gold"] = time.perf_counter() - t
    w("audit", "rejected_rows", ticketing_rejects(k))
    key_checks = quality.union_all([
        quality.key_summary(k.tickets, "silver.tickets", ["ticket_id"]),
        quality.key_summary(k.event_sales, "gold.event_sales", ["event_id"]),
        quality.key_summary(k.daily_metrics, "gold.daily_metrics", ["date"]),
        quality.key_summary(k.campaign_roi, "gold.campaign_roi", ["event_id", "channel"])])
    checks = w("audit", "key_checks", key_checks)
    failed = checks.where((F.col("null_key_rows") + F.col("duplicate_key_values")) > 0).count()
    append_history(spark, root, w.run_id, w("audit", "load_audit", w.stats_frame()))
    ok = failed == 0
    if ok and publish:
        w.publish()
    return RunReport(w.run_id, ok and publish, failed, secs,
                     {f"{s.layer}.{s.table}": s.rows for s in w.stats},
                     {f"{s.layer}.{s.table}": round(s.seconds, 3) for s in w.stats})
