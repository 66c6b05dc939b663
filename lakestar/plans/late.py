"""Late payments: only the months that they touch are rebuilt in the written subscription facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.operators.joins import materialize
from lakestar.plans import gold, silver
from lakestar.plans.build import Build
from lakestar.sources import sinks

FACT = "fact_subscription_events"


def rebuild(b: Build, payments: DataFrame, late: DataFrame, path: str) -> list[int]:
    """Bring the facts under ``path``, built from raw ``payments``, up to ``payments`` and ``late`` together.

    ``b`` holds the unchanged tables. A payment counts in the month its subscription started. A late row
    may also take the place of an earlier row of its id, in another month, so every month of a subscription
    that any row of a late id names is touched. Returns the touched months (0: no day), at most those of
    the calendar.
    """
    # written once: the raw rows are read for the months, for the ids and for the rows themselves
    marked = materialize(payments.withColumn("__late", F.lit(False)).unionByName(late.withColumn("__late", F.lit(True))))
    rows, late = marked.drop("__late"), marked.where("__late").drop("__late")
    starts = b.subscriptions.select("sub_id", F.col("start_date").alias("full_date")).join(
        F.broadcast(b.dim_date.select("full_date", gold.fact_month("date_key").alias("month"))), "full_date", "left")
    starts = starts.select("sub_id", F.coalesce("month", F.lit(0)).alias("month"))
    moved = rows.join(late.select("payment_id").distinct(), "payment_id", "left_semi").select("sub_id")
    months = sorted(r["month"] for r in moved.join(starts, "sub_id").select("month").distinct().collect())
    if not months:
        return []
    # all rows of every payment that names a subscription of those months: what its one valid row is chosen from
    ids = rows.join(starts.where(F.col("month").isin(months)), "sub_id", "left_semi").select("payment_id").distinct()
    again = rows.join(ids, "payment_id", "left_semi")
    rebuilt = materialize(silver.payments(again, b.subscriptions))
    star = gold.star_subscription_events(rebuilt, b.subscriptions, b.dim_user, b.dim_date, b.lk("dim_event_types"))
    sinks.overwrite_months(star, path, FACT, months)
    return months
