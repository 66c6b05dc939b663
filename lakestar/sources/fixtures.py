"""Raw (bronze) tables derived from the driver's TPC-H-style tables.

The reference lands seven sheets of a subscription business; no such data
ships with it, so equal-shaped raw tables are derived here from the driver's
parquet tables, with the dirt the silver rules exist for (duplicate ids,
padded ids, blank names, three date styles, unmatched labels, negative
amounts, out-of-range ratings). Every frame grows with its source tables.
The same derivations, as SQL, feed the DuckDB oracle (``lakestar.oracle_sql``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.joins import shuffled


def _legacy_id(k: Column) -> Column:
    """``U<id>``, with a leading space for ids ending in 1."""
    return F.concat(F.when(k % 10 == 1, F.lit(" ")).otherwise(F.lit("")), F.lit("U"), k.cast("string"))


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


class Fixtures:
    """Lazily built raw frames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- subscription domain ------------------------------------------------
    @cached_property
    def locations(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        j = n.join(r, n.n_regionkey == r.r_regionkey)
        first = j.select(
            F.col("n_nationkey").alias("country_id"),
            F.concat(F.lit(" N"), F.col("n_nationkey").cast("string")).alias("country_code"),
            F.concat(F.col("n_name"), F.lit(" ")).alias("country_name"),
            F.col("n_regionkey").alias("region_id"),
            F.concat(F.substring("r_name", 1, 2), F.lit(" ")).alias("region_code"),
            F.col("r_name").alias("region_name"))
        dup = j.where(F.col("n_nationkey") % 5 == 0).select(
            F.col("n_nationkey").alias("country_id"),
            F.concat(F.lit("Z"), F.col("n_nationkey").cast("string")).alias("country_code"),
            F.col("n_name").alias("country_name"),
            F.col("n_regionkey").alias("region_id"),
            F.lit("ZZ").alias("region_code"),
            F.col("r_name").alias("region_name"))
        return first.unionByName(dup)

    @cached_property
    def users(self) -> DataFrame:
        c = self.table("customer")
        k = F.col("c_custkey")
        name = (F.when(k % 97 == 5, F.lit("  "))
                .when(k % 89 == 3, _null("string"))
                .otherwise(F.concat(F.lit(" "), F.lower("c_name"), F.lit(" o'neil-"), F.col("c_mktsegment"))))
        signup = (F.when(k % 4 == 0, F.date_add(F.lit("2020-01-01").cast("date"), (k % 900).cast("int"))
                         .cast("string"))
                  .when(k % 4 == 1, F.concat((1 + k % 12).cast("string"), F.lit("/"),
                                             (1 + k % 28).cast("string"), F.lit("/"),
                                             (2018 + k % 7).cast("string")))
                  .when(k % 4 == 2, F.lit("n/a"))
                  .otherwise(_null("string")))
        base = c.select(
            k.alias("user_id"), _legacy_id(k).alias("user_legacy_id"), name.alias("name"),
            F.concat(F.lit("u"), k.cast("string"), F.lit("@example.com")).alias("email"),
            (18 + k % 60).cast("int").alias("age"),
            F.when(k % 50 == 7, F.lit(999)).otherwise(F.col("c_nationkey")).cast("int").alias("country_id"),
            signup.alias("signup_date"), F.col("c_mktsegment").alias("acquisition_source"))
        dup = c.where(k % 20 == 0).select(
            (k + 100000000).alias("user_id"), _legacy_id(k).alias("user_legacy_id"),
            F.lit("zz dup").alias("name"), _null("string").alias("email"), _null("int").alias("age"),
            F.col("c_nationkey").cast("int").alias("country_id"), _null("string").alias("signup_date"),
            _null("string").alias("acquisition_source"))
        return base.unionByName(dup).select(
            "*", _null("int").alias("region_id"), _null("string").alias("region_code"),
            _null("string").alias("region_name"))

    @cached_property
    def devices(self) -> DataFrame:
        c = self.table("customer")
        k = F.col("c_custkey")
        dtype = (F.when(k % 5 == 0, " mobile-x").when(k % 5 == 1, "SmartTV LG").when(k % 5 == 2, "tablet")
                 .when(k % 5 == 3, "web").otherwise("console"))
        osys = (F.when(k % 6 == 0, "android 14").when(k % 6 == 1, "IOS").when(k % 6 == 2, "webos")
                .when(k % 6 == 3, "Tizen").when(k % 6 == 4, "chromeOS").otherwise("other"))
        used = F.when(k % 2 == 0, F.lit("2024-01-05T10:11:12.123456Z")).otherwise(F.lit("2024-01-05"))
        return c.select(k.alias("device_id"), _legacy_id(k).alias("user_legacy_id"),
                        dtype.alias("device_type"), osys.alias("operating_system"), used.alias("last_used"))

    @cached_property
    def watchlist(self) -> DataFrame:
        p = self.table("part")
        k = F.col("p_partkey")
        return p.select(
            k.alias("content_id"), F.col("p_name").alias("title"),
            F.concat(F.lit(" "), F.lower("p_type")).alias("content_type"),
            F.when(k % 40 == 0, _null("string"))
             .otherwise(F.concat(F.col("p_brand"), F.lit(","), F.col("p_type"))).alias("genre"),
            (1990 + F.col("p_size") % 35).cast("int").alias("release_year"),
            _null("int").alias("seasons"), _null("int").alias("episodes"),
            _null("int").alias("content_duration_minutes"))

    @cached_property
    def subscriptions(self) -> DataFrame:
        o = self.table("orders")
        k = F.col("o_orderkey")

        def shifted(years: int) -> Column:
            return (F.col("o_orderdate") + F.expr(f"INTERVAL {years} YEARS")).cast("date").cast("string")

        start = F.when(k % 60 == 1, _null("string")).otherwise(shifted(23))
        end = (F.when(F.col("o_orderstatus") == "O", _null("string"))
               .when(k % 50 == 0, F.lit("2017-01-01")).otherwise(shifted(24)))
        event = (F.when(F.col("o_orderstatus") == "F", F.lit(" subscribe"))
                 .when(F.col("o_orderstatus") == "O", F.lit("renew")).otherwise(F.lit("Cancel")))
        ts = F.when(k % 3 == 0, F.concat(F.col("o_orderdate").cast("date").cast("string"),
                                         F.lit("T01:02:03.000004Z"))).otherwise(F.lit("bad"))
        return o.select(k.alias("sub_id"), _legacy_id(F.col("o_custkey")).alias("user_legacy_id"),
                        F.lower("o_orderpriority").alias("plan_type"), start.alias("start_date"),
                        end.alias("end_date"), event.alias("last_event_type"), ts.alias("last_event_timestamp"))

    @cached_property
    def payments(self) -> DataFrame:
        li = self.table("lineitem")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        j = li.join(shuffled(o), li.l_orderkey == o.o_orderkey)
        amount = (F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice"))
                  .when(F.col("l_quantity") == 50, _null("double")).otherwise(F.col("l_extendedprice")))
        pay_date = F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T00:00:0"),
                            F.col("l_linenumber").cast("string"), F.lit(".000001Z"))
        return j.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_id"),
                        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_legacy_id"),
                        F.col("l_orderkey").alias("sub_id"), amount.alias("amount"),
                        pay_date.alias("payment_date"), F.col("l_linestatus").alias("method"))

    @cached_property
    def viewing_activity(self) -> DataFrame:
        e = self.table("events")
        k, ts = F.col("event_id"), F.col("ts")
        start = (F.when(k % 3 == 0, ts.cast("date").cast("string"))
                 .when(k % 3 == 1, F.concat(F.month(ts).cast("string"), F.lit("/"), F.dayofmonth(ts).cast("string"),
                                            F.lit("/"), F.year(ts).cast("string"), F.lit(" 10:11")))
                 .otherwise(_null("string")))
        return e.select(
            k.alias("session_id"), _legacy_id(F.col("user_id")).alias("user_legacy_id"),
            ((k * 7) % 2500).alias("content_id"), F.col("user_id").alias("device_id"),
            start.alias("session_start_ts"), F.floor(F.col("value") * 10).cast("int").alias("duration_watched_sec"),
            F.col("value").cast("decimal(5,2)").alias("completion_percentage"),
            F.when(F.col("event_type") == "error", _null("int")).otherwise((k % 7).cast("int")).alias("rating"))

    def raw(self) -> dict[str, DataFrame]:
        return {"locations": self.locations, "users": self.users, "watchlist": self.watchlist,
                "devices": self.devices, "subscriptions": self.subscriptions, "payments": self.payments,
                "viewing_activity": self.viewing_activity}

    # ---- ticketing domain (documented-only KPIs) ------------------------------
    @cached_property
    def artists(self) -> DataFrame:
        s = self.table("supplier")
        k = F.col("s_suppkey")
        made = (F.when(k % 4 == 0, F.lit("2020-02-29")).when(k % 4 == 1, F.lit("2/30/2021"))
                .when(k % 4 == 2, F.lit("2024-01-05 garbage")).otherwise(_null("string")))
        return s.select(k.alias("artist_id"), F.concat(F.lit(" "), F.col("s_name")).alias("name"),
                        F.when(k % 3 == 0, _null("string")).otherwise(F.lit("rock")).alias("genre"),
                        F.col("s_nationkey").cast("string").alias("country"), made.alias("created_at"))

    @cached_property
    def venues(self) -> DataFrame:
        n = self.table("nation")
        return n.select(F.col("n_nationkey").alias("venue_id"), F.col("n_name").alias("name"),
                        (40 + F.col("n_nationkey")).cast("string").alias("capacity"))

    @cached_property
    def ticket_events(self) -> DataFrame:
        p = self.table("part")
        k = F.col("p_partkey")
        status = F.when(k % 3 == 0, " Scheduled").when(k % 3 == 1, "CANCELLED").otherwise("tbd?")
        return p.select(k.alias("event_id"), F.col("p_size").alias("artist_id"), (k % 25).alias("venue_id"),
                        F.date_add(F.lit("1995-01-01").cast("date"), (k % 2000).cast("int")).cast("string")
                        .alias("event_date"),
                        status.alias("status"), F.col("p_retailprice").cast("string").alias("ticket_price"))

    @cached_property
    def customers(self) -> DataFrame:
        c = self.table("customer")
        return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                        F.concat(F.lit(" User"), F.col("c_custkey").cast("string"), F.lit("@Example.COM "))
                        .alias("email"))

    @cached_property
    def tickets(self) -> DataFrame:
        li = self.table("lineitem")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        return j.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ticket_id"),
                        F.col("l_partkey").alias("event_id"), F.col("o_custkey").alias("customer_id"),
                        F.col("o_orderdate").alias("purchase_datetime"),
                        F.lower("o_orderpriority").alias("channel"),
                        F.col("l_extendedprice").cast("decimal(12,2)").alias("price_paid"))

    @cached_property
    def checkins(self) -> DataFrame:
        li = self.table("lineitem").where(F.col("l_returnflag") == "A")
        tid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return li.select((tid * 10 + 1).alias("checkin_id"), F.col("l_partkey").alias("event_id"),
                         tid.alias("ticket_id"))

    @cached_property
    def refunds(self) -> DataFrame:
        li = self.table("lineitem").where(F.col("l_returnflag") == "R")
        tid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return li.select((tid * 10 + 2).alias("refund_id"), tid.alias("ticket_id"),
                         F.col("l_partkey").alias("event_id"),
                         F.col("l_extendedprice").cast("decimal(12,2)").alias("refund_amount"),
                         F.col("l_shipdate").alias("refunded_at"))

    @cached_property
    def campaigns(self) -> DataFrame:
        p = self.table("part")
        k = F.col("p_partkey")
        channel = (F.when(k % 5 == 0, "1-urgent").when(k % 5 == 1, "2-high").when(k % 5 == 2, "3-medium")
                   .when(k % 5 == 3, "4-not specified").otherwise("5-low"))
        start = (F.when(k % 4 == 0, F.date_add(F.lit("2020-01-01").cast("date"), (k % 700).cast("int")).cast("string"))
                 .when(k % 4 == 1, F.concat((k % 12 + 1).cast("string"), F.lit("/"), (k % 31 + 1).cast("string"), F.lit("/2021")))
                 .when(k % 4 == 2, F.lit("soon")).otherwise(_null("string")))
        end = F.when(k % 2 == 0, F.lit("2022-02-28")).otherwise(F.lit("2/30/2022"))
        return p.select(k.alias("campaign_id"), k.alias("event_id"), channel.alias("channel"),
                        F.col("p_retailprice").cast("decimal(12,2)").alias("spend"), start.alias("start_date"), end.alias("end_date"))
