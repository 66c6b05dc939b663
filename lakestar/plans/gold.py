"""Gold layer: star schema (date, user, content dimensions; subscription and viewing facts).

``dim_date`` is broadcast (a fixed calendar, 2,922 rows). Lookups are joined as Catalyst plans it from their
sizes; subscriptions, ``dim_user`` and ``dim_content`` grow with the input and are shuffled; AQE splits a hot user key
across tasks.

A fact's star joins are left joins with markers (``star_*``): one pass gives the fact rows (every marker
set) and the lost rows with the first join that failed. Facts are laid out by month (``fact_month``,
yyyymm), so a report on some months reads those months only.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions import dates
from lakestar.functions.conform import conform
from lakestar.operators.dedupe import desc, first_per_key
from lakestar.operators.joins import shuffled
from lakestar.operators.lookups import attach_name

# The calendar range of the date dimension.
CALENDAR_START = "2018-01-01"
CALENDAR_END = "2025-12-31"


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day; the only generated table (size fixed by the range)."""
    d = F.col("full_date")
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    dow = dates.iso_day_of_week(d)
    out = days.select(dates.date_key(d).alias("date_key"), d, F.year(d).alias("year"),
                      F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
                      dow.alias("day_of_week"), dates.month_name(d).alias("month_name"),
                      dow.isin(6, 7).alias("is_weekend"))
    return conform(out, schemas.GOLD["dim_date"].schema)


def dim_content(watchlist: DataFrame, content_types: DataFrame, genres: DataFrame) -> DataFrame:
    w = watchlist.select("content_id", "title", "content_type_id", "genre_id", "release_year")
    w = attach_name(w, "content_type_id", content_types, "content_type_name")
    w = attach_name(w, "genre_id", genres, "genre_name")
    out = w.select(F.col("content_id").cast("string").alias("content_key"), "title", "content_type_name",
                   "genre_name", "release_year")
    return conform(out, schemas.GOLD["dim_content"].schema)


def subscription_summary(subscriptions: DataFrame) -> DataFrame:
    """Per user: first start date and the latest subscription, in one aggregation.

    Latest = start date descending with NULL first (a subscription without a
    parsed start wins, as in the reference's default DESC order), then the
    highest ``sub_id``.
    """
    s = subscriptions.select("user_legacy_id", "start_date", "sub_id", "end_date", "plan_type_id")
    picked = first_per_key(s, ["user_legacy_id"], [desc("start_date", nulls_first=True), desc("sub_id")],
                           extra_aggs=[F.min("start_date").alias("first_subscription_date")])
    return picked.select("user_legacy_id", "first_subscription_date",
                         F.col("end_date").alias("latest_end_date"),
                         F.col("plan_type_id").alias("latest_plan_type_id"))


def dim_user(users: DataFrame, locations: DataFrame, subscriptions: DataFrame, plan_types: DataFrame,
             as_of: dt.date | str | None = None) -> DataFrame:
    """User dimension: geography, first subscription date, current plan, active flag.

    ``as_of`` stands for the reference's CURRENT_DATE so that runs repeat.
    """
    as_of_col = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    u = users.select("user_legacy_id", "name", "email", "country_id")
    geo = locations.select("country_id", "country_name", "region_name")
    j = u.join(geo, "country_id", "left")
    j = j.join(shuffled(subscription_summary(subscriptions)), "user_legacy_id", "left")
    j = attach_name(j, "latest_plan_type_id", plan_types, "plan_type_name", "current_plan_type")
    # The reference groups the user x subscription fan-out by these columns; the
    # fan-out is pre-aggregated above, so the group is one row per silver user.
    g = (j.groupBy(F.trim("user_legacy_id").alias("user_key"), "name", "email", "country_name", "region_name",
                   "current_plan_type", "latest_end_date")
         .agg(F.min("first_subscription_date").alias("first_subscription_date")))
    out = g.select("user_key", "name", "email", "country_name", "region_name", "first_subscription_date",
                   "current_plan_type",
                   (F.col("latest_end_date").isNull() | (F.col("latest_end_date") > as_of_col)).alias("is_active"))
    return conform(out, schemas.GOLD["dim_user"].schema)


def _calendar(dim_date_df: DataFrame) -> DataFrame:
    # dim_date has a fixed size (one row per day of the range): safe to broadcast.
    return F.broadcast(dim_date_df.select("full_date", "date_key"))


def _star(df: DataFrame, name: str, source_key: Column, lookups: list[tuple[Column, str, Column]]) -> DataFrame:
    """Fact columns of ``name``, ``source_key``, the first failed lookup, ``kept`` and ``fact_month``.

    ``lookups``: (found, reason if not, the key that was looked for) in the order in which they are blamed.
    """
    reason = F.coalesce(*[F.when(~found, F.lit(why)) for found, why, _ in lookups])
    key = F.coalesce(*[F.when(~found, F.coalesce(k.cast("string"), F.lit("NULL"))) for found, _, k in lookups])
    kept = reduce(lambda x, y: x & y, [found for found, _, _ in lookups])
    facts = conform(df, schemas.GOLD[name].schema).columns
    out = df.withColumns({"source_key": source_key.cast("string"), "lost_reason": reason,
                          "lost_key": F.when(~kept, key), "kept": kept, "fact_month": fact_month("date_key")})
    return conform(out, schemas.star_schema(name)).select(*facts, *schemas.STAR_COLUMNS)


def fact_month(date_key: str) -> Column:
    """yyyymm of a date key; 0 for a row without a day."""
    return F.coalesce(F.expr(f"CAST({date_key} div 100 AS INT)"), F.lit(0))


def facts(star: DataFrame, name: str) -> DataFrame:
    """The star's fact rows (Catalyst turns the left joins into inner joins)."""
    return star.where("kept").select(*schemas.GOLD[name].schema.names)


def lost(star: DataFrame, name: str) -> DataFrame:
    """(fact_table, lost_reason, lost_key, lost_rows): source rows that became no fact, by the first failed lookup."""
    return (star.where(~F.col("kept")).groupBy("lost_reason", "lost_key").agg(F.count(F.lit(1)).alias("lost_rows"))
            .select(F.lit(f"gold.{name}").alias("fact_table"), "lost_reason", "lost_key", "lost_rows"))


def star_subscription_events(payments: DataFrame, subscriptions: DataFrame, dim_user_df: DataFrame,
                             dim_date_df: DataFrame, event_types: DataFrame) -> DataFrame:
    """Every payment, with what its subscription, its start day and event type, and its user were found to be."""
    s = subscriptions.select("sub_id", "start_date", "last_event_type_id", F.lit(True).alias("__sub"))
    s = s.join(_calendar(dim_date_df), s.start_date == F.col("full_date"), "left")
    et = event_types.select(F.col("event_type_id").alias("last_event_type_id"), "event_type_name")
    s = s.join(et, "last_event_type_id", "left").drop("full_date")
    p = payments.select("payment_id", "sub_id", F.trim("user_legacy_id").alias("user_key"),
                        F.col("amount").alias("mrr_change"))
    f = p.join(shuffled(s), "sub_id", "left")
    f = f.join(shuffled(dim_user_df.select("user_key", F.lit(True).alias("__user"))), "user_key", "left")
    return _star(f, "fact_subscription_events", F.col("payment_id"), [
        (F.col("__sub").isNotNull(), "subscription is not in silver", F.col("sub_id")),
        (F.col("date_key").isNotNull(), "start date is not in dim_date", F.col("start_date")),
        (F.col("event_type_name").isNotNull(), "subscription has no event type", F.col("sub_id")),
        (F.col("__user").isNotNull(), "user is not in dim_user", F.col("user_key"))])


def fact_subscription_events(payments: DataFrame, subscriptions: DataFrame, dim_user_df: DataFrame,
                             dim_date_df: DataFrame, event_types: DataFrame) -> DataFrame:
    return facts(star_subscription_events(payments, subscriptions, dim_user_df, dim_date_df, event_types),
                 "fact_subscription_events")


def star_viewing_activity(viewing: DataFrame, dim_user_df: DataFrame, dim_content_df: DataFrame,
                          dim_date_df: DataFrame) -> DataFrame:
    """Every session, with what its day, content and user were found to be."""
    v = viewing.select("session_id", F.trim("user_legacy_id").alias("user_key"),
                       F.col("content_id").cast("string").alias("content_key"), F.col("device_id").cast("string").alias("device_id"),
                       F.to_date("session_start_ts").alias("__day"), "duration_watched_sec", F.col("rating").alias("user_rating"))
    v = v.join(_calendar(dim_date_df), F.col("__day") == F.col("full_date"), "left")
    v = v.join(shuffled(dim_content_df.select("content_key", F.lit(True).alias("__content"))), "content_key", "left")
    v = v.join(shuffled(dim_user_df.select("user_key", F.lit(True).alias("__user"))), "user_key", "left")
    return _star(v, "fact_viewing_activity", F.col("session_id"), [
        (F.col("date_key").isNotNull(), "session day is not in dim_date", F.col("__day")),
        (F.col("__content").isNotNull(), "content is not in dim_content", F.col("content_key")),
        (F.col("__user").isNotNull(), "user is not in dim_user", F.col("user_key"))])


def fact_viewing_activity(viewing: DataFrame, dim_user_df: DataFrame, dim_content_df: DataFrame,
                          dim_date_df: DataFrame) -> DataFrame:
    return facts(star_viewing_activity(viewing, dim_user_df, dim_content_df, dim_date_df), "fact_viewing_activity")


def mrr_by_month_event(fact_sub: DataFrame, dim_date_df: DataFrame, days: Column | None = None) -> DataFrame:
    """Monthly MRR change and event count per event type (the star's headline report).

    ``days`` narrows the calendar. On a fact laid out by month the join carries the month too, so that
    partitions without such a day are not read (runtime partition pruning).
    """
    cal = dim_date_df if days is None else dim_date_df.where(days)
    on = ["fact_month", "date_key"] if "fact_month" in fact_sub.columns else ["date_key"]
    cal = F.broadcast(cal.withColumn("fact_month", fact_month("date_key")).select(*on, "year", "month", "month_name"))
    j = fact_sub.join(cal, on)
    return (j.groupBy("year", "month", "month_name", "event_type_name")
            .agg(F.sum("mrr_change").cast("decimal(18,2)").alias("mrr_change"),
                 F.count(F.lit(1)).alias("events")))
