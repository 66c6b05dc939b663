"""Silver layer: typed, cleaned, deduplicated, foreign-key-valid tables and lookups.

Order inside every table build: FK existence (left join with a marker, see
``check_fks``) and row rules (WHERE) -> one row per key (``first_per_key``) ->
parse / label / attach ids -> assignment cast to the silver schema. Deduplicating after the rules means an
invalid duplicate never hides a valid row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions import dates, text
from lakestar.functions.conform import conform
from lakestar.operators.dedupe import asc, first_per_key
from lakestar.operators.joins import shuffled
from lakestar.operators.lookups import LookupSet, attach_id_by_value, build_lookups

# lookup name -> (raw table, raw column, label function, id column, name column)
LOOKUP_SPECS = {
    "dim_genres": ("watchlist", "genre", text.genre_label, "genre_id", "genre_name"),
    "dim_content_types": ("watchlist", "content_type", text.content_type_label, "content_type_id",
                          "content_type_name"),
    "dim_device_types": ("devices", "device_type", text.device_type_label, "device_type_id", "device_type_name"),
    "dim_os": ("devices", "operating_system", text.os_label, "os_id", "os_name"),
    "dim_plan_types": ("subscriptions", "plan_type", text.plan_type_label, "plan_type_id", "plan_type_name"),
    "dim_event_types": ("subscriptions", "last_event_type", text.event_type_label, "event_type_id",
                        "event_type_name"),
}

# Tie-breaks for the one-row-per-key pick (the reference leaves them arbitrary).
DEDUPE = {
    "locations": (["country_id"], [asc("country_code")]),
    "users": (["user_legacy_id"], [asc("user_id")]),
    "watchlist": (["content_id"], []),
    "devices": (["device_id"], []),
    "subscriptions": (["sub_id"], []),
    "payments": (["payment_id"], [asc("amount"), asc("payment_date"), asc("method")]),
    "viewing_activity": (["session_id"], []),
}


# FK existence tests per table: (raw column, parent table, parent column). Parent keys
# are unique (each parent is one row per key), so a left join never fans out.
FK_TESTS = {
    "users": [("country_id", "locations", "country_id")],
    "devices": [("user_legacy_id", "users", "user_legacy_id")],
    "subscriptions": [("user_legacy_id", "users", "user_legacy_id")],
    "payments": [("sub_id", "subscriptions", "sub_id")],
    "viewing_activity": [("user_legacy_id", "users", "user_legacy_id"), ("content_id", "watchlist", "content_id"),
                         ("device_id", "devices", "device_id")],
}


GROWING = {"users", "watchlist", "devices", "subscriptions"}  # parents that grow with the input; locations do not


def fk_marker(parent: str) -> str:
    return f"__in_{parent}"


def check_fks(table: str, raw_df: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Raw rows plus one marker per FK test: TRUE when the key exists in the parent, else NULL.

    The same checked frame yields both the silver rows (all markers set) and the
    reject records (a marker missing), so in a run the FK joins of a raw table
    are done once. Raw columns keep their order (it is the tie-break order).
    """
    out = raw_df
    for col, parent, pcol in FK_TESTS[table]:
        keys = parents[parent].select(F.col(pcol).alias(col), F.lit(True).alias(fk_marker(parent)))
        out = out.join(shuffled(keys) if parent in GROWING else keys, col, "left")
    return out.select(*raw_df.columns, *[fk_marker(p) for _, p, _ in FK_TESTS[table]])


def fk_passed(checked: DataFrame) -> DataFrame:
    """Rows whose every FK exists (Catalyst turns the left joins into inner joins)."""
    markers = [c for c in checked.columns if c.startswith("__in_")]
    passed = checked.where(reduce(lambda a, b: a & b, [F.col(m).isNotNull() for m in markers]))
    return passed.drop(*[c for c in checked.columns if c.startswith("__")])


def all_lookups(raw: dict[str, DataFrame]) -> LookupSet:
    """The six lookups (and their raw-value maps) from one distinct job."""
    return build_lookups(raw, LOOKUP_SPECS)


def _pick(df: DataFrame, table: str) -> DataFrame:
    keys, orders = DEDUPE[table]
    return first_per_key(df, keys, orders)


def locations(raw_locations: DataFrame) -> DataFrame:
    kept = raw_locations.where(F.col("country_id").isNotNull())
    d = _pick(kept, "locations")
    out = d.select("country_id", F.trim("country_code").alias("country_code"),
                   F.trim("country_name").alias("country_name"), "region_id",
                   F.trim("region_code").alias("region_code"), F.trim("region_name").alias("region_name"))
    return conform(out, schemas.SILVER["locations"].schema)


def users_rules(raw_users: DataFrame) -> DataFrame:
    return raw_users.where(F.col("user_legacy_id").isNotNull() & ~text.is_blank("name"))


def users(raw_users: DataFrame, locations_df: DataFrame | None = None,
          checked: DataFrame | None = None) -> DataFrame:
    checked = checked if checked is not None else check_fks("users", raw_users, {"locations": locations_df})
    kept = users_rules(fk_passed(checked))
    d = _pick(kept, "users")
    out = d.select("user_id", "user_legacy_id", text.initcap_alnum(F.trim("name")).alias("name"), "email",
                   "age", "country_id", "region_id", "region_code", "region_name",
                   dates.iso_or_us_date("signup_date").alias("signup_date"), "acquisition_source")
    return conform(out, schemas.SILVER["users"].schema)


def watchlist(raw_watchlist: DataFrame, content_type_map: DataFrame, genre_map: DataFrame) -> DataFrame:
    d = _pick(raw_watchlist.where(F.col("content_id").isNotNull()), "watchlist")
    d = attach_id_by_value(d, "content_type", content_type_map, "content_type_id")
    d = attach_id_by_value(d, "genre", genre_map, "genre_id")
    return conform(d, schemas.SILVER["watchlist"].schema)


def devices(raw_devices: DataFrame, users_df: DataFrame | None, device_type_map: DataFrame, os_map: DataFrame,
            checked: DataFrame | None = None) -> DataFrame:
    checked = checked if checked is not None else check_fks("devices", raw_devices, {"users": users_df})
    kept = fk_passed(checked).where(F.col("device_id").isNotNull())
    d = _pick(kept, "devices")
    d = attach_id_by_value(d, "device_type", device_type_map, "device_type_id")
    d = attach_id_by_value(d, "operating_system", os_map, "os_id")
    d = d.withColumn("last_used", dates.strict_iso_timestamp("last_used"))
    return conform(d, schemas.SILVER["devices"].schema)


def end_not_before_start() -> F.Column:
    end, start = F.col("end_date"), F.col("start_date")
    return end.isNull() | (dates.text_to_date(end) >= dates.text_to_date(start))


def subscriptions(raw_subs: DataFrame, users_df: DataFrame | None, plan_type_map: DataFrame,
                  event_type_map: DataFrame, checked: DataFrame | None = None) -> DataFrame:
    checked = checked if checked is not None else check_fks("subscriptions", raw_subs, {"users": users_df})
    kept = fk_passed(checked).where(F.col("sub_id").isNotNull() & end_not_before_start())
    d = _pick(kept, "subscriptions")
    d = attach_id_by_value(d, "plan_type", plan_type_map, "plan_type_id")
    d = attach_id_by_value(d, "last_event_type", event_type_map, "last_event_type_id")
    d = d.select("sub_id", "user_legacy_id", "plan_type_id",
                 dates.strict_iso_date("start_date").alias("start_date"),
                 dates.strict_iso_date("end_date").alias("end_date"), "last_event_type_id",
                 dates.strict_iso_timestamp("last_event_timestamp").alias("last_event_timestamp"))
    return conform(d, schemas.SILVER["subscriptions"].schema)


def payments(raw_payments: DataFrame, subscriptions_df: DataFrame | None,
             checked: DataFrame | None = None) -> DataFrame:
    checked = checked if checked is not None else check_fks("payments", raw_payments,
                                                            {"subscriptions": subscriptions_df})
    kept = fk_passed(checked).where(F.col("payment_id").isNotNull() & (F.col("amount") >= 0))
    d = _pick(kept, "payments")
    d = d.withColumn("payment_date", dates.strict_iso_timestamp("payment_date"))
    return conform(d, schemas.SILVER["payments"].schema)


def rating_ok() -> F.Column:
    r = F.col("rating")
    return r.isNull() | ((r >= 1) & (r <= 5))


def viewing_activity(raw_viewing: DataFrame, users_df: DataFrame | None, watchlist_df: DataFrame | None,
                     devices_df: DataFrame | None, checked: DataFrame | None = None) -> DataFrame:
    checked = checked if checked is not None else check_fks(
        "viewing_activity", raw_viewing, {"users": users_df, "watchlist": watchlist_df, "devices": devices_df})
    kept = fk_passed(checked).where(F.col("session_id").isNotNull() & rating_ok())
    d = _pick(kept, "viewing_activity")
    d = d.withColumn("session_start_ts", dates.iso_or_us_timestamp("session_start_ts"))
    return conform(d, schemas.SILVER["viewing_activity"].schema)
