"""Benchmark: the full run (bronze -> silver -> gold -> checks -> publish) plus the
headline report over the published star schema.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line. Outputs go to a fresh scratch folder per run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakestar.plans import gold, pipeline  # noqa: E402
from lakestar.session import get_spark  # noqa: E402
from lakestar.sources.fixtures import Fixtures  # noqa: E402
from lakestar.sources.sinks import read_published  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="lakestar-bench-")
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                      extra_conf={"spark.driver.memory": "8g",
                                  "spark.checkpoint.dir": os.path.join(scratch, "checkpoints")})
    t_all = time.perf_counter()
    report = pipeline.run(spark, Fixtures(spark, sf_dir).raw(), os.path.join(scratch, "warehouse"))
    t = time.perf_counter()
    root = os.path.join(scratch, "warehouse")
    mrr = gold.mrr_by_month_event(read_published(spark, root, "gold", "fact_subscription_events"),
                                  read_published(spark, root, "gold", "dim_date"))
    mrr_rows = mrr.count()
    report_secs = time.perf_counter() - t
    total = time.perf_counter() - t_all

    queries = {f"stage_{k}": round(v, 3) for k, v in report.seconds.items()}
    queries["silver_plus_gold"] = round(report.seconds["silver"] + report.seconds["gold"], 3)
    queries["mrr_by_month_event"] = round(report_secs, 3)
    queries.update({f"write_{k}": v for k, v in report.table_seconds.items()})
    print(json.dumps({
        "metric": "pipeline_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows": {k: v for k, v in report.rows.items() if k.startswith(("silver.", "gold."))},
        "published": report.published,
        "failed_checks": report.failed_checks,
        "mrr_rows": mrr_rows,
    }))


if __name__ == "__main__":
    main()
