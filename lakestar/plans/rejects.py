"""Rejected rows (the reference declares ``audit.rejected_rows`` but never fills it).

Every raw row is tested against all rules of its silver table in one pass: row
rules are Column predicates, and a foreign-key miss is a missing marker in the
FK-checked raw table the silver build itself reads (``Build.checked``), so in a
run the FK joins are not repeated for the rejects. A row yields one reject record per rule
it breaks, with its JSON image. Rules that null a value but keep the row (a
pattern-matching date that is not a real date, an unknown device label) are
reported too: the reference would have aborted the whole load on those. Texts that do not fit their column's
type, and malformed lines, come from flags of the same rows (``conform.flagged``), so no table is read twice.

``rejection_id`` is a digest of the reject's content and the number of its occurrence, the same in every run;
occurrences are counted by an aggregate, so a row that repeats a million times is one row until then.
``row_image`` holds the row as VARIANT, for fields to be read by name; ``replay`` makes raw rows of them again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions import dates, text
from lakestar.functions.conform import LANDED, LINE, LOST
from lakestar.plans.build import Build
from lakestar.plans.kpis import EVENT_STATUSES, Ticketing, conform_enum
from lakestar.plans.silver import end_not_before_start, fk_marker, rating_ok

REJECT_COLUMNS = ["rejection_id", "source_table", "target_table", "rejection_reason", "row_key", "row_data", "row_image",
                  "occurrence", "rejected_at"]
_CONTENT = ["source_table", "target_table", "rejection_reason", "row_key", "row_data"]
MALFORMED = "malformed line"
_FOUND = "array<struct<why:string,key:string>>"


def _matched_but_null(raw: Column, patterns: list[str], parsed: Column) -> Column:
    matched = None
    for p in patterns:
        m = raw.rlike(p)
        matched = m if matched is None else (matched | m)
    return raw.isNotNull() & matched & parsed.isNull()


def _rejects(table: str, df: DataFrame, key: str, rules: list[tuple[str, Column]],
             raw_cols: list[str]) -> DataFrame:
    """One row per broken rule: the content columns of a reject."""
    image, row_key = F.to_json(F.struct(*[F.col(c) for c in raw_cols])), F.col(key).cast("string")
    target = F.lit(f"silver.{table}")
    entry = lambda why, k: F.struct(why.alias("why"), k.alias("key"))
    # no lambda functions: Spark would interpret the rules row by row; the empty entries of kept rules are left out below
    found = F.array(*[F.when(cond, entry(F.lit(reason), row_key)) for reason, cond in rules])
    if LOST in df.columns:
        line = F.col(LINE).isNotNull()
        # a value lost by its cast is reported under the key as it was landed
        landed = F.array_repeat(F.get_json_object(LANDED, f"$.{key}"), F.size(LOST))
        lost = F.when(F.col(LOST).isNotNull(), F.arrays_zip(F.col(LOST), landed)).cast(_FOUND)
        malformed = F.array(entry(F.lit(MALFORMED), F.lit(None).cast("string")))
        found = F.when(line, malformed).otherwise(F.concat(found, F.coalesce(lost, F.array().cast(_FOUND))))
        image = F.when(line, F.to_json(F.struct(F.col(LINE).alias("line")))).otherwise(F.coalesce(F.col(LANDED), image))
        target = F.when(line, F.lit(f"bronze.{table}")).otherwise(target)
    return (df.select("*", F.explode(found).alias("__found")).where(F.col("__found").isNotNull())
            .select(F.lit(f"raw.{table}").alias("source_table"), target.alias("target_table"),
                    F.col("__found.why").alias("rejection_reason"), F.col("__found.key").alias("row_key"),
                    image.alias("row_data")))


def _numbered(rejects: DataFrame) -> DataFrame:
    """All columns of a reject, from its content: equal rejects are told apart by their occurrence."""
    parts = [F.coalesce(F.col(c), F.lit("\x00")) for c in _CONTENT]
    return (rejects.groupBy(*_CONTENT).agg(F.count(F.lit(1)).alias("__n"))
            .select("*", F.explode(F.expr("sequence(1L, __n)")).alias("occurrence"))
            .withColumn("rejection_id", F.concat_ws("-", F.sha2(F.concat_ws("\x01", *parts), 256), F.col("occurrence")))
            .withColumn("row_image", F.parse_json("row_data")).withColumn("rejected_at", F.current_timestamp())
            .select(*REJECT_COLUMNS))


def replay(rejects: DataFrame, table: str) -> DataFrame:
    """The raw rows behind a table's rejects, typed, each once, with the ``reasons`` it was rejected for.

    Corrected, they can be fed to the silver build of the table again. Fields that do not fit their type are NULL.
    """
    mine = rejects.where((F.col("source_table") == f"raw.{table}") & (F.col("rejection_reason") != MALFORMED))
    # the image is an aggregate's value, not its key: Catalyst would push conditions on its fields, and with them the
    # making and parsing of JSON, down to the joins of the raw tables, once for every row and condition
    rows = mine.groupBy(F.sha2("row_data", 256).alias("digest"), "occurrence").agg(
        F.any_value(F.parse_json("row_data")).alias("image"),
        F.sort_array(F.collect_set("rejection_reason")).alias("reasons"))
    return rows.select(*[F.try_variant_get("image", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
                         for f in schemas.RAW[table].fields], "reasons")


def _fk_miss(parent: str) -> Column:
    return F.col(fk_marker(parent)).isNull()


def rejected_rows(b: Build) -> DataFrame:
    raw = b.raw
    out = []

    r = raw["locations"]
    out.append(_rejects("locations", b.flagged["locations"], "country_id",
                        [("country_id is null", F.col("country_id").isNull())], r.columns))

    r = raw["users"]
    j = b.checked("users")
    out.append(_rejects("users", j, "user_id", [
        ("user_legacy_id is null", F.col("user_legacy_id").isNull()),
        ("name is blank", text.is_blank("name")),
        ("country_id not in locations", _fk_miss("locations")),
        ("signup_date is not a valid date",
         _matched_but_null(F.col("signup_date"), [dates.ISO_DATE_PREFIX, dates.US_DATE_EXACT],
                           dates.iso_or_us_date("signup_date"))),
    ], r.columns))

    r = raw["watchlist"]
    out.append(_rejects("watchlist", b.flagged["watchlist"], "content_id",
                        [("content_id is null", F.col("content_id").isNull())], r.columns))

    r = raw["devices"]
    j = b.checked("devices")
    out.append(_rejects("devices", j, "device_id", [
        ("device_id is null", F.col("device_id").isNull()),
        ("user_legacy_id not in users", _fk_miss("users")),
        ("device_type has no canonical label",
         F.col("device_type").isNotNull() & text.device_type_label("device_type").isNull()),
        ("operating_system has no canonical label",
         F.col("operating_system").isNotNull() & text.os_label("operating_system").isNull()),
        ("last_used is not a valid timestamp",
         _matched_but_null(F.col("last_used"), [dates.ISO_TIMESTAMP_MICROS_Z], dates.strict_iso_timestamp("last_used"))),
    ], r.columns))

    r = raw["subscriptions"]
    j = b.checked("subscriptions")
    out.append(_rejects("subscriptions", j, "sub_id", [
        ("sub_id is null", F.col("sub_id").isNull()),
        ("end_date before start_date", F.coalesce(~end_not_before_start(), F.lit(False))),
        ("end_date cannot be compared with start_date", F.col("end_date").isNotNull() & end_not_before_start().isNull()),
        ("user_legacy_id not in users", _fk_miss("users")),
        ("start_date is not a valid date",
         _matched_but_null(F.col("start_date"), [dates.ISO_DATE_EXACT], dates.strict_iso_date("start_date"))),
        ("end_date is not a valid date",
         _matched_but_null(F.col("end_date"), [dates.ISO_DATE_EXACT], dates.strict_iso_date("end_date"))),
        ("last_event_timestamp is not a valid timestamp",
         _matched_but_null(F.col("last_event_timestamp"), [dates.ISO_TIMESTAMP_MICROS_Z],
                           dates.strict_iso_timestamp("last_event_timestamp"))),
    ], r.columns))

    r = raw["payments"]
    j = b.checked("payments")
    out.append(_rejects("payments", j, "payment_id", [
        ("payment_id is null", F.col("payment_id").isNull()),
        ("amount is negative or missing", ~F.coalesce(F.col("amount") >= 0, F.lit(False))),
        ("sub_id not in subscriptions", _fk_miss("subscriptions")),
        ("amount does not fit numeric(10,2)",
         F.col("amount").isNotNull() & F.col("amount").try_cast("decimal(10,2)").isNull()),
        ("payment_date is not a valid timestamp",
         _matched_but_null(F.col("payment_date"), [dates.ISO_TIMESTAMP_MICROS_Z],
                           dates.strict_iso_timestamp("payment_date"))),
    ], r.columns))

    r = raw["viewing_activity"]
    j = b.checked("viewing_activity")
    out.append(_rejects("viewing_activity", j, "session_id", [
        ("session_id is null", F.col("session_id").isNull()),
        ("rating outside 1..5", ~F.coalesce(rating_ok(), F.lit(False))),
        ("user_legacy_id not in users", _fk_miss("users")),
        ("content_id not in watchlist", _fk_miss("watchlist")),
        ("device_id not in devices", _fk_miss("devices")),
        ("completion_percentage does not fit numeric(5,2)",
         F.col("completion_percentage").isNotNull() & F.col("completion_percentage").try_cast("decimal(5,2)").isNull()),
        ("session_start_ts is not a valid timestamp",
         _matched_but_null(F.col("session_start_ts"), [dates.ISO_DATE_PREFIX, dates.US_DATE_PREFIX],
                           dates.iso_or_us_timestamp("session_start_ts"))),
    ], r.columns))

    res = out[0]
    for f in out[1:]:
        res = res.unionByName(f)
    return _numbered(res)


def ticketing_rejects(k: Ticketing) -> DataFrame:
    """Rejects of the ticketing tables: rows a silver table drops, and values it empties (labels outside their
    set, dates and numbers that are none)."""
    def unread(c: str, parsed: Column) -> Column:
        return F.col(c).isNotNull() & parsed.isNull()

    def missing(df: DataFrame, parent: DataFrame, col: str, name: str) -> DataFrame:
        return df.join(parent.select(col, F.lit(True).alias(fk_marker(name))), col, "left")

    day = dates.iso_or_us_date
    rules = {
        "venues": ("venue_id", [], [("capacity", "capacity is not a number", lambda: F.trim("capacity").try_cast("double"))]),
        "events": ("event_id", [], [("status", "status is not a known status", lambda: conform_enum("status", EVENT_STATUSES)),
                                    ("event_date", "event_date is not a valid date", lambda: dates.text_to_date("event_date"))]),
        "customers": ("customer_id", [], []),
        "artists": ("artist_id", [], [("created_at", "created_at is not a valid date", lambda: day("created_at"))]),
        "tickets": ("ticket_id", [("event_id", "events"), ("customer_id", "customers")], []),
        "checkins": ("checkin_id", [("ticket_id", "tickets")], []),
        "refunds": ("refund_id", [("ticket_id", "tickets")], []),
        "campaigns": ("campaign_id", [("event_id", "events")], [
            (c, f"{c} is not a valid date", lambda c=c: day(c)) for c in ("start_date", "end_date")]),
    }
    out = []
    for table, (key, parents, values) in rules.items():
        if table not in k.raw:
            continue
        raw = df = k.raw[table]
        for col, parent in parents:
            df = missing(df, getattr(k, parent), col, parent)
        found = [(f"{key} is null", F.col(key).isNull())]
        found += [(f"{col} not in {parent}", _fk_miss(parent)) for col, parent in parents]
        found += [(why, unread(c, parsed())) for c, why, parsed in values if c in raw.columns]
        out.append(_rejects(table, df, key, found, raw.columns))
    return _numbered(reduce(lambda a, b: a.unionByName(b), out))
