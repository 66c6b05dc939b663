"""Ticketing KPIs (documented by the reference, never coded there).

Silver rules: dedupe by key, integer capacity, enum and e-mail conforming,
foreign-key-valid tickets / check-ins / refunds (check-ins and refunds take the
event of their surviving ticket). Gold KPIs pre-aggregate each fact per key and
then join the one-row-per-key results, so no join fans out.
Formulas are ours (the documents name the columns only):
  tickets_sold = tickets of the event (refunded ones included)
  attendance   = distinct checked-in tickets
  no_show_rate = 1 - attendance / tickets_sold        (NULL when no tickets)
  net_revenue  = gross_revenue - refunds_amount
  sell_through = tickets_sold / venue_capacity         (NULL when capacity is 0 or unknown)
  daily: refunds are charged to the ticket's purchase date
  cpa = spend / conv_tickets, roi = (conv_revenue - spend) / spend   (NULL on a zero divisor)
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar import schemas
from lakestar.functions import dates
from lakestar.functions.conform import cast_to, typed
from lakestar.operators.dedupe import asc, first_per_key
from lakestar.operators.joins import materialize, semi
from lakestar.sources.fixtures import Fixtures

# Allowed event statuses (ours; the documents say "enum(status)" only).
EVENT_STATUSES = ["scheduled", "cancelled", "postponed", "completed"]


def conform_enum(c: Column | str, allowed: list[str] | None = None) -> Column:
    """Lower-cased, trimmed label; NULL when an allowed set is given and the label is outside it."""
    c = F.lower(F.trim(F.col(c) if isinstance(c, str) else c))
    return c if allowed is None else F.when(c.isin(*allowed), c)


def normalise_email(c: Column | str) -> Column:
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


REUSED = ("events", "tickets", "refunds")  # read by several later steps


def _more(table: str, df: DataFrame, done: list[str]) -> list[Column]:
    """The documented columns that the input carries and no rule above names, typed."""
    out = []
    for f in schemas.RAW_TICKETING[table].fields:
        if f.name in done or f.name not in df.columns:
            continue
        c = F.col(f.name)
        if f.name == "created_at":
            c = dates.iso_or_us_date(c)
        elif f.name == "scanned_at":
            c = dates.text_to_timestamp(c)
        elif f.name == "status":
            c = conform_enum(c)
        elif isinstance(f.dataType, T.StringType):
            c = F.trim(c)
        out.append(c.alias(f.name))
    return out


class Ticketing:
    """``sink(layer, name, df)`` (optional) writes each finished table and returns it read back."""

    def __init__(self, raw: dict[str, DataFrame], sink=None):
        self.raw = {t: typed(df, schemas.RAW_TICKETING[t]) for t, df in raw.items()}
        self.sink = sink

    def _out(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        if self.sink is not None:
            return self.sink(layer, name, df)
        return materialize(df) if name in REUSED else df

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "Ticketing":
        fx = Fixtures(spark, sf_dir)
        return cls({"artists": fx.artists, "venues": fx.venues, "events": fx.ticket_events, "customers": fx.customers,
                    "tickets": fx.tickets, "checkins": fx.checkins, "refunds": fx.refunds,
                    "campaigns": fx.campaigns})

    # ---- silver ----
    @cached_property
    def artists(self) -> DataFrame:
        """Artists, one row per id (needs a raw ``artists`` table)."""
        a = first_per_key(self.raw["artists"].where(F.col("artist_id").isNotNull()), ["artist_id"])
        out = a.select("artist_id", F.trim("name").alias("name"), "genre", "country",
                       dates.iso_or_us_date("created_at").alias("created_at"))
        return self._out("silver", "artists", out)

    @cached_property
    def venues(self) -> DataFrame:
        v = first_per_key(self.raw["venues"].where(F.col("venue_id").isNotNull()), ["venue_id"])
        cap = cast_to(F.col("capacity"), v.schema["capacity"].dataType, T.IntegerType())
        out = v.select("venue_id", "name", cap.alias("capacity"), *_more("venues", v, ["venue_id", "name", "capacity"]))
        return self._out("silver", "venues", out)

    @cached_property
    def events(self) -> DataFrame:
        e = first_per_key(self.raw["events"].where(F.col("event_id").isNotNull()), ["event_id"])
        out = e.select("event_id", "artist_id", "venue_id", dates.text_to_date("event_date").alias("event_date"),
                       conform_enum("status", EVENT_STATUSES).alias("status"),
                       F.col("ticket_price").try_cast("decimal(10,2)").alias("ticket_price"),
                       *_more("events", e, ["event_id", "artist_id", "venue_id", "event_date", "status", "ticket_price"]))
        return self._out("silver", "events", out)

    @cached_property
    def customers(self) -> DataFrame:
        c = first_per_key(self.raw["customers"].where(F.col("customer_id").isNotNull()), ["customer_id"])
        out = c.select("customer_id", "name", normalise_email("email").alias("email"),
                       *_more("customers", c, ["customer_id", "name", "email"]))
        return self._out("silver", "customers", out)

    @cached_property
    def tickets(self) -> DataFrame:
        t = self.raw["tickets"].where(F.col("ticket_id").isNotNull())
        t = semi(t, self.events.select("event_id"), "event_id")
        t = semi(t, self.customers.select("customer_id"), "customer_id")
        t = first_per_key(t, ["ticket_id"], [asc("event_id"), asc("purchase_datetime"), asc("channel"),
                                             asc("price_paid")])
        out = t.select("ticket_id", "event_id", "customer_id", "purchase_datetime",
                       conform_enum("channel").alias("channel"), "price_paid",
                       *_more("tickets", t, ["ticket_id", "event_id", "customer_id", "purchase_datetime", "channel",
                                             "price_paid"]))
        return self._out("silver", "tickets", out)

    def _via_ticket(self, df: DataFrame, key: str, orders) -> DataFrame:
        """FK-valid rows, deduplicated, carrying the event of their ticket."""
        owner = self.tickets.select("ticket_id", F.col("event_id").alias("__ticket_event"))
        j = df.where(F.col(key).isNotNull()).join(owner, "ticket_id")
        return first_per_key(j, [key], orders)

    @cached_property
    def checkins(self) -> DataFrame:
        c = self._via_ticket(self.raw["checkins"], "checkin_id", [])
        out = c.select("checkin_id", F.col("__ticket_event").alias("event_id"), "ticket_id",
                       *_more("checkins", c, ["checkin_id", "event_id", "ticket_id"]))
        return self._out("silver", "checkins", out)

    @cached_property
    def refunds(self) -> DataFrame:
        r = self._via_ticket(self.raw["refunds"], "refund_id", [asc("refund_amount"), asc("refunded_at")])
        out = r.select("refund_id", "ticket_id", F.col("__ticket_event").alias("event_id"), "refund_amount",
                       "refunded_at", *_more("refunds", r, ["refund_id", "ticket_id", "event_id", "refund_amount",
                                                            "refunded_at"]))
        return self._out("silver", "refunds", out)

    @cached_property
    def campaigns(self) -> DataFrame:
        c = self.raw["campaigns"].where(F.col("campaign_id").isNotNull())
        c = first_per_key(semi(c, self.events.select("event_id"), "event_id"), ["campaign_id"])
        # campaign dates are conformed when the input carries them (ISO or M/D/YYYY text)
        dated = [dates.iso_or_us_date(d).alias(d) for d in ("start_date", "end_date") if d in c.columns]
        out = c.select("campaign_id", "event_id", conform_enum("channel").alias("channel"), "spend", *dated,
                       *_more("campaigns", c, ["campaign_id", "event_id", "channel", "spend", "start_date", "end_date"]))
        return self._out("silver", "campaigns", out)

    # ---- gold ----
    @cached_property
    def event_sales(self) -> DataFrame:
        sold = self.tickets.groupBy("event_id").agg(F.count(F.lit(1)).alias("tickets_sold"),
                                                    F.sum("price_paid").alias("gross_revenue"))
        came = (self.checkins.select("event_id", "ticket_id").distinct()
                .groupBy("event_id").agg(F.count(F.lit(1)).alias("attendance")))
        back = self.refunds.groupBy("event_id").agg(F.sum("refund_amount").alias("refunds_amount"))
        venue = self.venues.select("venue_id", F.col("capacity").alias("venue_capacity"))
        e = (self.events.select("event_id", "event_date", "artist_id", "venue_id")
             .join(venue, "venue_id", "left").join(sold, "event_id", "left")
             .join(came, "event_id", "left").join(back, "event_id", "left"))
        sold_n = F.coalesce("tickets_sold", F.lit(0)).cast("long")
        came_n = F.coalesce("attendance", F.lit(0)).cast("long")
        gross = F.coalesce("gross_revenue", F.lit(0)).cast("decimal(18,2)")
        refunds = F.coalesce("refunds_amount", F.lit(0)).cast("decimal(18,2)")
        out = e.select("event_id", "event_date", "artist_id", "venue_id", "venue_capacity",
                       sold_n.alias("tickets_sold"), came_n.alias("attendance"),
                       (F.lit(1.0) - _ratio(came_n, sold_n)).alias("no_show_rate"),
                       gross.alias("gross_revenue"), refunds.alias("refunds_amount"),
                       (gross - refunds).cast("decimal(18,2)").alias("net_revenue"),
                       _ratio(sold_n, F.col("venue_capacity")).alias("sell_through"))
        return self._out("gold", "event_sales", out)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        t = self.tickets.select("ticket_id", F.to_date("purchase_datetime").alias("date"), "price_paid")
        sold = t.groupBy("date").agg(F.count(F.lit(1)).alias("tickets_sold"),
                                     F.sum("price_paid").alias("gross_revenue"))
        per_ticket = self.refunds.groupBy("ticket_id").agg(F.sum("refund_amount").alias("refund"))
        back = (per_ticket.join(t.select("ticket_id", "date"), "ticket_id")
                .groupBy("date").agg(F.sum("refund").alias("refunds")))
        # tickets without a purchase date have a day of their own (NULL), their refunds with them
        back = back.withColumnRenamed("date", "back_date")
        d = sold.join(back, F.col("date").eqNullSafe(F.col("back_date")), "left")
        gross = F.col("gross_revenue").cast("decimal(18,2)")
        out = d.select("date", F.col("tickets_sold").cast("long").alias("tickets_sold"),
                       gross.alias("gross_revenue"),
                       (gross - F.coalesce("refunds", F.lit(0))).cast("decimal(18,2)").alias("net_revenue"))
        return self._out("gold", "daily_metrics", out)

    @cached_property
    def campaign_roi(self) -> DataFrame:
        spend = self.campaigns.groupBy("event_id", "channel").agg(F.sum("spend").alias("spend"))
        conv = self.tickets.groupBy("event_id", "channel").agg(F.count(F.lit(1)).alias("conv_tickets"),
                                                               F.sum("price_paid").alias("conv_revenue"))
        j = spend.join(conv, ["event_id", "channel"], "left")
        sp = F.col("spend").cast("decimal(18,2)")
        n = F.coalesce("conv_tickets", F.lit(0)).cast("long")
        rev = F.coalesce("conv_revenue", F.lit(0)).cast("decimal(18,2)")
        out = j.select("event_id", "channel", sp.alias("spend"), n.alias("conv_tickets"), rev.alias("conv_revenue"),
                       _ratio(sp, n).alias("cpa"), _ratio(rev - sp, sp).alias("roi"))
        return self._out("gold", "campaign_roi", out)
