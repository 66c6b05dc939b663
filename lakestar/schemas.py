"""Table contracts: typed schemas, keys, foreign keys, NOT NULL and text limits.

Spark does not enforce constraints, so they are data here and checked by
``lakestar.operators.quality``. Entity ids are 64-bit (100 TB of rows does not
fit 32-bit ids); lookup ids are 32-bit surrogate keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
TS, B, SH = T.TimestampNTZType(), T.BooleanType(), T.ShortType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    varchar: dict = field(default_factory=dict)          # column -> max chars
    numeric: tuple[str, ...] = ()                        # columns with a bounded precision
    fks: tuple[tuple[str, str, str], ...] = ()           # (column, parent table, parent column)


# --- raw landing contract: ids and measures numeric, dates and labels text ---
RAW = {
    "locations": struct(("country_id", I), ("country_code", S), ("country_name", S), ("region_id", I),
                        ("region_code", S), ("region_name", S)),
    "users": struct(("user_id", L), ("user_legacy_id", S), ("name", S), ("email", S), ("age", I),
                    ("country_id", I), ("region_id", I), ("region_code", S), ("region_name", S),
                    ("signup_date", S), ("acquisition_source", S)),
    "watchlist": struct(("content_id", L), ("title", S), ("content_type", S), ("genre", S),
                        ("release_year", I), ("seasons", I), ("episodes", I),
                        ("content_duration_minutes", I)),
    "devices": struct(("device_id", L), ("user_legacy_id", S), ("device_type", S),
                      ("operating_system", S), ("last_used", S)),
    "subscriptions": struct(("sub_id", L), ("user_legacy_id", S), ("plan_type", S), ("start_date", S),
                            ("end_date", S), ("last_event_type", S), ("last_event_timestamp", S)),
    "payments": struct(("payment_id", L), ("user_legacy_id", S), ("sub_id", L), ("amount", T.DoubleType()),
                       ("payment_date", S), ("method", S)),
    "viewing_activity": struct(("session_id", L), ("user_legacy_id", S), ("content_id", L), ("device_id", L),
                               ("session_start_ts", S), ("duration_watched_sec", I),
                               ("completion_percentage", T.DoubleType()), ("rating", I)),
}
RAW_TABLES = list(RAW)
SUBSCRIPTION_TABLES = tuple(RAW_TABLES)

# --- documented ticketing inputs (column lists from the data dictionary) ---
RAW_TICKETING = {
    "artists": struct(("artist_id", L), ("name", S), ("genre", S), ("country", S), ("created_at", S)),
    "venues": struct(("venue_id", L), ("name", S), ("city", S), ("state", S), ("country", S), ("capacity", S)),
    "events": struct(("event_id", L), ("artist_id", L), ("venue_id", L), ("event_date", S), ("status", S),
                     ("ticket_price", S), ("currency", S)),
    "customers": struct(("customer_id", L), ("name", S), ("email", S), ("city", S), ("state", S), ("country", S),
                        ("created_at", S)),
    "tickets": struct(("ticket_id", L), ("event_id", L), ("customer_id", L), ("purchase_datetime", TS),
                      ("channel", S), ("price_paid", dec(12, 2)), ("currency", S), ("status", S)),
    "checkins": struct(("checkin_id", L), ("event_id", L), ("ticket_id", L), ("scanned_at", S), ("gate", S)),
    "refunds": struct(("refund_id", L), ("ticket_id", L), ("event_id", L), ("reason", S),
                      ("refund_amount", dec(12, 2)), ("refunded_at", TS)),
    "campaigns": struct(("campaign_id", L), ("event_id", L), ("channel", S), ("spend", dec(12, 2)),
                        ("impressions", L), ("clicks", L), ("conversions", L), ("start_date", S), ("end_date", S)),
}
RAW.update({f"ticketing.{n}": s for n, s in RAW_TICKETING.items()})
RAW_STRING = {n: struct(*[(f.name, S) for f in s.fields]) for n, s in RAW.items()}


def _lookup(name: str, id_col: str, name_col: str) -> Table:
    return Table(name, struct((id_col, I), (name_col, S)), key=(id_col,), unique=((name_col,),),
                 not_null=(id_col, name_col))


LOOKUPS = {
    "dim_genres": _lookup("dim_genres", "genre_id", "genre_name"),
    "dim_content_types": _lookup("dim_content_types", "content_type_id", "content_type_name"),
    "dim_device_types": _lookup("dim_device_types", "device_type_id", "device_type_name"),
    "dim_os": _lookup("dim_os", "os_id", "os_name"),
    "dim_plan_types": _lookup("dim_plan_types", "plan_type_id", "plan_type_name"),
    "dim_event_types": _lookup("dim_event_types", "event_type_id", "event_type_name"),
}

SILVER = {
    "locations": Table("locations", struct(
        ("country_id", I), ("country_code", S), ("country_name", S), ("region_id", I),
        ("region_code", S), ("region_name", S)),
        key=("country_id",), not_null=("country_id",),
        varchar={"country_code": 10, "country_name": 255, "region_code": 10, "region_name": 255}),
    "users": Table("users", struct(
        ("user_id", L), ("user_legacy_id", S), ("name", S), ("email", S), ("age", I), ("country_id", I),
        ("region_id", I), ("region_code", S), ("region_name", S), ("signup_date", D),
        ("acquisition_source", S)),
        key=("user_id",), unique=(("user_legacy_id",),), not_null=("user_id", "user_legacy_id"),
        varchar={"user_legacy_id": 255, "name": 255, "email": 255, "region_code": 10, "region_name": 255,
                 "acquisition_source": 100},
        fks=(("country_id", "locations", "country_id"),)),
    "watchlist": Table("watchlist", struct(
        ("content_id", L), ("title", S), ("content_type_id", I), ("genre_id", I), ("release_year", I),
        ("seasons", I), ("episodes", I), ("content_duration_minutes", I)),
        key=("content_id",), not_null=("content_id",),
        fks=(("content_type_id", "dim_content_types", "content_type_id"),
             ("genre_id", "dim_genres", "genre_id"))),
    "devices": Table("devices", struct(
        ("device_id", L), ("user_legacy_id", S), ("device_type_id", I), ("os_id", I), ("last_used", TS)),
        key=("device_id",), not_null=("device_id",), varchar={"user_legacy_id": 255},
        fks=(("user_legacy_id", "users", "user_legacy_id"),
             ("device_type_id", "dim_device_types", "device_type_id"), ("os_id", "dim_os", "os_id"))),
    "subscriptions": Table("subscriptions", struct(
        ("sub_id", L), ("user_legacy_id", S), ("plan_type_id", I), ("start_date", D), ("end_date", D),
        ("last_event_type_id", I), ("last_event_timestamp", TS)),
        key=("sub_id",), not_null=("sub_id",), varchar={"user_legacy_id": 255},
        fks=(("user_legacy_id", "users", "user_legacy_id"),
             ("plan_type_id", "dim_plan_types", "plan_type_id"),
             ("last_event_type_id", "dim_event_types", "event_type_id"))),
    "payments": Table("payments", struct(
        ("payment_id", L), ("user_legacy_id", S), ("sub_id", L), ("amount", dec(10, 2)),
        ("payment_date", TS), ("method", S)),
        key=("payment_id",), not_null=("payment_id",), varchar={"user_legacy_id": 255, "method": 50},
        numeric=("amount",), fks=(("sub_id", "subscriptions", "sub_id"),)),
    "viewing_activity": Table("viewing_activity", struct(
        ("session_id", L), ("user_legacy_id", S), ("content_id", L), ("device_id", L),
        ("session_start_ts", TS), ("duration_watched_sec", I), ("completion_percentage", dec(5, 2)),
        ("rating", I)),
        key=("session_id",), not_null=("session_id",), varchar={"user_legacy_id": 255},
        numeric=("completion_percentage",),
        fks=(("user_legacy_id", "users", "user_legacy_id"), ("content_id", "watchlist", "content_id"),
             ("device_id", "devices", "device_id"))),
}

GOLD = {
    "dim_date": Table("dim_date", struct(
        ("date_key", I), ("full_date", D), ("year", SH), ("quarter", SH), ("month", SH), ("day", SH),
        ("day_of_week", SH), ("month_name", S), ("is_weekend", B)),
        key=("date_key",), unique=(("full_date",),),
        not_null=("date_key", "full_date", "year", "quarter", "month", "day", "day_of_week"),
        varchar={"month_name": 20}),
    "dim_user": Table("dim_user", struct(
        ("user_key", S), ("name", S), ("email", S), ("country_name", S), ("region_name", S),
        ("first_subscription_date", D), ("current_plan_type", S), ("is_active", B)),
        key=("user_key",), not_null=("user_key",),
        varchar={"user_key": 255, "name": 255, "email": 255, "country_name": 100, "region_name": 100,
                 "current_plan_type": 50}),
    "dim_content": Table("dim_content", struct(
        ("content_key", S), ("title", S), ("content_type_name", S), ("genre_name", S), ("release_year", SH)),
        key=("content_key",), not_null=("content_key",),
        varchar={"content_key": 255, "title": 255, "content_type_name": 50, "genre_name": 50}),
    "fact_subscription_events": Table("fact_subscription_events", struct(
        ("date_key", I), ("user_key", S), ("event_type_name", S), ("mrr_change", dec(10, 2))),
        not_null=("date_key", "user_key", "event_type_name"),
        varchar={"user_key": 255, "event_type_name": 50}, numeric=("mrr_change",),
        fks=(("date_key", "dim_date", "date_key"), ("user_key", "dim_user", "user_key"))),
    "fact_viewing_activity": Table("fact_viewing_activity", struct(
        ("date_key", I), ("user_key", S), ("content_key", S), ("device_id", S),
        ("duration_watched_sec", I), ("user_rating", SH)),
        not_null=("date_key", "user_key", "content_key"),
        varchar={"user_key": 255, "content_key": 255, "device_id": 255},
        fks=(("date_key", "dim_date", "date_key"), ("user_key", "dim_user", "user_key"),
             ("content_key", "dim_content", "content_key"))),
}

# Facts are written with their lost rows, one partition per (kept, month).
FACTS = tuple(n for n in GOLD if n.startswith("fact_"))
STAR_COLUMNS = ("source_key", "lost_reason", "lost_key", "kept", "fact_month")
LAYOUT = ("kept", "fact_month")


def star_schema(name: str) -> T.StructType:
    return T.StructType([*GOLD[name].schema.fields,
                         *struct(("source_key", S), ("lost_reason", S), ("lost_key", S), ("kept", B), ("fact_month", I)).fields])
