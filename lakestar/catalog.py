"""Registry of named queries: a Spark builder and (where SQL can say it) a DuckDB oracle.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables; nothing is collected.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import oracle_sql as O
from lakestar import schemas
from lakestar.functions import dates, text
from lakestar.functions.conform import conform
from lakestar.operators import audit
from lakestar.operators.dedupe import asc, first_per_key
from lakestar.operators.joins import anti, semi
from lakestar.operators.lookups import attach_id_by_value
from lakestar.operators.quality import (
    column_checks,
    dq_results,
    key_summary,
    orphan_summary,
    precision_summary,
    union_all,
)
from lakestar.plans import gold, late, silver
from lakestar.plans.build import DEFAULT_AS_OF, Build, Kept
from lakestar.plans.kpis import Ticketing
from lakestar.plans.pipeline import GOLD_WAVES, SILVER_WAVES, build_waves, quality_frames
from lakestar.plans.rejects import rejected_rows, replay, ticketing_rejects
from lakestar.session import ensure_checkpoint_dir
from lakestar.sources.fixtures import Fixtures
from lakestar.sources.landing import land
from lakestar.sources.sinks import LayerWriter, append_history, load_history, read_facts, register_tables

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Builder
    oracle: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Entry(fn, oracle)
        return fn
    return deco


def _b(spark: SparkSession, sf_dir: str) -> Build:
    return Build.from_fixtures(spark, sf_dir)


def _attr_query(name: str, attr: str, oracle_cte: str) -> None:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_b(spark, sf_dir), attr)
    fn.__name__ = name
    REGISTRY[name] = Entry(fn, O.table(oracle_cte))


# ---- lookups (A1, L1-L7) ----
for _lk in ["dim_genres", "dim_content_types", "dim_device_types", "dim_os", "dim_plan_types", "dim_event_types"]:
    def _mk(lk=_lk):
        def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _b(spark, sf_dir).lk(lk)
        fn.__name__ = lk
        REGISTRY[lk] = Entry(fn, O.table(lk))
    _mk()

# ---- silver (D1-D7) ----
for _t in ["locations", "users", "watchlist", "devices", "subscriptions", "payments", "viewing_activity"]:
    _attr_query(f"silver_{_t}", _t, f"silver_{_t}")

# ---- gold (D10-D13) and the headline report ----
for _t in ["dim_content", "dim_user", "fact_subscription_events", "fact_viewing_activity", "mrr_by_month_event"]:
    _attr_query(_t, _t, _t)


# ---------------------------------------------------------------------------
# Operator-level queries: each runs one rule of the build over a whole raw table.
def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Fixtures(spark, sf_dir).raw()


RAW_CTE = {"locations": "raw_locations", "users": "raw_users", "watchlist": "raw_watchlist",
           "devices": "raw_devices", "subscriptions": "raw_subscriptions", "payments": "raw_payments",
           "viewing_activity": "raw_viewing"}


# ---- ingest (S1, S4, S6, S7, P13) ----
# rows without a name stand for blank sheet rows: every cell of theirs is NULL before landing
_BLANKED = ", ".join(f"CASE WHEN name IS NOT NULL THEN {c} END AS {c}" for c in schemas.RAW["users"].names)


@register("drop_all_null_rows", O.query(f"""
SELECT CAST(user_id AS BIGINT) AS user_id, * EXCLUDE (user_id) FROM (SELECT {_BLANKED} FROM raw_users) x
WHERE NOT (user_id IS NULL AND user_legacy_id IS NULL AND name IS NULL AND email IS NULL AND age IS NULL
           AND country_id IS NULL AND region_id IS NULL AND region_code IS NULL AND region_name IS NULL
           AND signup_date IS NULL AND acquisition_source IS NULL)""", "raw_users"))
def q_drop_all_null_rows(spark, sf_dir):
    users = conform(_raw(spark, sf_dir)["users"], schemas.RAW["users"])
    return land(users.select(*[F.when(F.col("name").isNotNull(), F.col(c)).alias(c) for c in users.columns]))


@register("row_count_audit", O.query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM {c}" for t, c in RAW_CTE.items()),
    *RAW_CTE.values()))
def q_row_count_audit(spark, sf_dir):
    return audit.row_counts(_raw(spark, sf_dir))


@register("content_fingerprint", O.union_query(
    [O.fingerprint_sql(t, c, schemas.RAW[t]) for t, c in RAW_CTE.items()], list(RAW_CTE.values())))
def q_content_fingerprint(spark, sf_dir):
    raw = {t: conform(df, schemas.RAW[t]) for t, df in _raw(spark, sf_dir).items()}
    frames = [audit.fingerprint(df).select(F.lit(t).alias("table_name"), "*") for t, df in raw.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("conform_types", O.query("""
SELECT CAST(payment_id AS BIGINT) AS payment_id, user_legacy_id, CAST(sub_id AS BIGINT) AS sub_id,
       try_cast(amount AS DECIMAL(10,2)) AS amount, try_cast(payment_date AS TIMESTAMP) AS payment_date, method
FROM raw_payments""", "raw_payments"))
def q_conform_types(spark, sf_dir):
    return conform(_raw(spark, sf_dir)["payments"], schemas.SILVER["payments"].schema)


# ---- scalar functions (F1-F14, L1-L6) ----
@register("initcap_alnum", O.query(f"""
SELECT CAST(user_id AS BIGINT) AS user_id, {O.initcap('trim(name)')} AS name_title FROM raw_users""", "raw_users"))
def q_initcap(spark, sf_dir):
    return _raw(spark, sf_dir)["users"].select("user_id", text.initcap_alnum(F.trim("name")).alias("name_title"))


@register("split_part_genre", O.query("""
SELECT content_id, split_part(trim(genre), ',', 1) AS genre_label FROM raw_watchlist""", "raw_watchlist"))
def q_split_part(spark, sf_dir):
    return _raw(spark, sf_dir)["watchlist"].select("content_id", text.genre_label("genre").alias("genre_label"))


@register("device_label", O.query(f"""
SELECT device_id, {O.device_case('device_type')} AS device_label FROM raw_devices""", "raw_devices"))
def q_device_label(spark, sf_dir):
    return _raw(spark, sf_dir)["devices"].select("device_id", text.device_type_label("device_type").alias("device_label"))


@register("os_label", O.query(f"""
SELECT device_id, {O.os_case('operating_system')} AS os_label FROM raw_devices""", "raw_devices"))
def q_os_label(spark, sf_dir):
    return _raw(spark, sf_dir)["devices"].select("device_id", text.os_label("operating_system").alias("os_label"))


@register("event_label", O.query(f"""
SELECT sub_id, {O.event_case('last_event_type')} AS event_label FROM raw_subscriptions""", "raw_subscriptions"))
def q_event_label(spark, sf_dir):
    return _raw(spark, sf_dir)["subscriptions"].select(
        "sub_id", text.event_type_label("last_event_type").alias("event_label"))


@register("parse_iso_or_us_date", O.query(f"""
SELECT CAST(user_id AS BIGINT) AS user_id, signup_date AS raw_value, {O.signup_date('signup_date')} AS parsed
FROM raw_users""", "raw_users"))
def q_parse_mixed_date(spark, sf_dir):
    return _raw(spark, sf_dir)["users"].select("user_id", F.col("signup_date").alias("raw_value"),
                                               dates.iso_or_us_date("signup_date").alias("parsed"))


@register("parse_us_date", O.query("""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(try_strptime(signup_date, '%m/%d/%Y') AS DATE) AS parsed
FROM raw_users""", "raw_users"))
def q_parse_us_date(spark, sf_dir):
    return _raw(spark, sf_dir)["users"].select("user_id", dates.us_text_to_date("signup_date").alias("parsed"))


@register("parse_iso_date", O.query(f"""
SELECT sub_id, {O.strict_date('start_date')} AS start_date, {O.strict_date('end_date')} AS end_date
FROM raw_subscriptions""", "raw_subscriptions"))
def q_parse_iso_date(spark, sf_dir):
    return _raw(spark, sf_dir)["subscriptions"].select(
        "sub_id", dates.strict_iso_date("start_date").alias("start_date"),
        dates.strict_iso_date("end_date").alias("end_date"))


@register("parse_mixed_timestamp", O.query(f"""
SELECT session_id, {O.mixed_ts('session_start_ts')} AS session_start_ts FROM raw_viewing""", "raw_viewing"))
def q_parse_mixed_ts(spark, sf_dir):
    return _raw(spark, sf_dir)["viewing_activity"].select(
        "session_id", dates.iso_or_us_timestamp("session_start_ts").alias("session_start_ts"))


@register("strict_iso_timestamp", O.query(f"""
SELECT device_id, last_used AS raw_value, {O.strict_ts('last_used')} AS last_used FROM raw_devices""", "raw_devices"))
def q_strict_ts(spark, sf_dir):
    # last_used mixes full ISO timestamps with date-only values; only the former parse
    return _raw(spark, sf_dir)["devices"].select(
        "device_id", F.col("last_used").alias("raw_value"), dates.strict_iso_timestamp("last_used").alias("last_used"))


@register("date_parts", O.query(f"""
SELECT sub_id, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS "year",
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS "month",
       CAST(day(d) AS INTEGER) AS "day", CAST(isodow(d) AS INTEGER) AS day_of_week,
       strftime(d, '%B') AS month_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT sub_id, {O.strict_date('start_date')} AS d FROM raw_subscriptions) s""", "raw_subscriptions"))
def q_date_parts(spark, sf_dir):
    s = _raw(spark, sf_dir)["subscriptions"].select("sub_id", dates.strict_iso_date("start_date").alias("d"))
    d = F.col("d")
    dow = dates.iso_day_of_week(d)
    return s.select("sub_id", dates.date_key(d).alias("date_key"), F.year(d).alias("year"),
                    F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
                    dow.cast("int").alias("day_of_week"), dates.month_name(d).alias("month_name"),
                    dow.isin(6, 7).alias("is_weekend"))


# ---- filters (P2-P6) ----
@register("non_blank_name", O.query("""
SELECT CAST(user_id AS BIGINT) AS user_id, user_legacy_id FROM raw_users
WHERE name IS NOT NULL AND trim(name) <> ''""", "raw_users"))
def q_non_blank(spark, sf_dir):
    return _raw(spark, sf_dir)["users"].where(~text.is_blank("name")).select("user_id", "user_legacy_id")


@register("non_negative_amount", O.query("""
SELECT payment_id, amount FROM raw_payments WHERE amount >= 0""", "raw_payments"))
def q_non_negative(spark, sf_dir):
    return _raw(spark, sf_dir)["payments"].where(F.col("amount") >= 0).select("payment_id", "amount")


@register("rating_domain", O.query("""
SELECT session_id, rating FROM raw_viewing WHERE rating IS NULL OR (rating >= 1 AND rating <= 5)""", "raw_viewing"))
def q_rating(spark, sf_dir):
    return _raw(spark, sf_dir)["viewing_activity"].where(silver.rating_ok()).select("session_id", "rating")


@register("end_after_start", O.query("""
SELECT sub_id, start_date, end_date FROM raw_subscriptions
WHERE end_date IS NULL OR try_cast(end_date AS DATE) >= try_cast(start_date AS DATE)""", "raw_subscriptions"))
def q_end_after_start(spark, sf_dir):
    return _raw(spark, sf_dir)["subscriptions"].where(silver.end_not_before_start()).select(
        "sub_id", "start_date", "end_date")


# ---- dedupe / window (A2, W1, A3) ----
@register("distinct_on_first", O.query(f"""
SELECT DISTINCT ON (payment_id) payment_id, user_legacy_id, sub_id, amount, payment_date, method
FROM raw_payments
ORDER BY payment_id, amount ASC NULLS LAST, payment_date ASC NULLS LAST, method ASC NULLS LAST,
         {O.nf('user_legacy_id', 'sub_id', 'amount', 'payment_date', 'method')}""", "raw_payments"))
def q_distinct_on(spark, sf_dir):
    return first_per_key(_raw(spark, sf_dir)["payments"], ["payment_id"],
                         [asc("amount"), asc("payment_date"), asc("method")])


@register("latest_subscription", O.query("""
SELECT user_legacy_id, first_start AS first_subscription_date, latest.until AS latest_end_date,
       latest.plan AS latest_plan_type_id
FROM subscriber_state""", "subscriber_state"))
def q_latest_subscription(spark, sf_dir):
    return gold.subscription_summary(_b(spark, sf_dir).subscriptions)


# ---- joins (J1-J15) ----
@register("fk_valid_semi", O.query("""
SELECT sub_id, user_legacy_id FROM raw_subscriptions
WHERE user_legacy_id IN (SELECT user_legacy_id FROM silver_users)""", "raw_subscriptions", "silver_users"))
def q_fk_semi(spark, sf_dir):
    b = _b(spark, sf_dir)
    return semi(b.raw["subscriptions"], b.users.select("user_legacy_id"), "user_legacy_id").select(
        "sub_id", "user_legacy_id")


@register("fk_orphans_anti", O.query("""
SELECT session_id, content_id FROM raw_viewing
WHERE content_id IS NOT NULL AND content_id NOT IN (SELECT content_id FROM silver_watchlist)""",
    "raw_viewing", "silver_watchlist"))
def q_fk_anti(spark, sf_dir):
    b = _b(spark, sf_dir)
    v = b.raw["viewing_activity"].where(F.col("content_id").isNotNull())
    return anti(v, b.watchlist.select("content_id"), "content_id").select("session_id", "content_id")


@register("lookup_attach", O.query(f"""
SELECT d.device_id, dt.device_type_id, o.os_id FROM raw_devices d
LEFT JOIN dim_device_types dt ON dt.device_type_name = {O.device_case('d.device_type')}
LEFT JOIN dim_os o ON o.os_name = {O.os_case('d.operating_system')}""", "raw_devices", "dim_device_types", "dim_os"))
def q_lookup_attach(spark, sf_dir):
    b = _b(spark, sf_dir)
    d = attach_id_by_value(b.raw["devices"], "device_type", b.vmap("dim_device_types"), "device_type_id")
    d = attach_id_by_value(d, "operating_system", b.vmap("dim_os"), "os_id")
    return d.select("device_id", "device_type_id", "os_id")


@register("date_lookup", O.query("""
SELECT v.session_id, d.date_key, d.is_weekend FROM silver_viewing_activity v
JOIN dim_date d ON d.full_date = CAST(v.session_start_ts AS DATE)""", "silver_viewing_activity", "dim_date"))
def q_date_lookup(spark, sf_dir):
    b = _b(spark, sf_dir)
    v = b.viewing_activity.select("session_id", F.to_date("session_start_ts").alias("full_date"))
    return v.join(F.broadcast(b.dim_date.select("full_date", "date_key", "is_weekend")), "full_date").select(
        "session_id", "date_key", "is_weekend")


# ---- quality (Q1-Q7), rejects (S15), DQ results (S16) ----
def _quality(spark, sf_dir):
    b = Build(spark, _raw(spark, sf_dir), sink=Kept(checked=False))
    build_waves(b, SILVER_WAVES + GOLD_WAVES)
    return quality_frames(b)


_QS = O.quality_sql()


@register("pk_violations", O.union_query(*_QS["pk"]))
def q_pk(spark, sf_dir):
    return _quality(spark, sf_dir)["pk"]


@register("not_null_violations", O.union_query(*_QS["not_null"]))
def q_not_null(spark, sf_dir):
    return _quality(spark, sf_dir)["not_null"]


@register("varchar_overflow", O.union_query(*_QS["varchar"]))
def q_varchar(spark, sf_dir):
    return _quality(spark, sf_dir)["varchar"]


@register("fk_violations", O.union_query(*_QS["fk"]))
def q_fk(spark, sf_dir):
    return _quality(spark, sf_dir)["fk"]


@register("precision_overflow", O.query("""
SELECT 'raw.payments' AS table_name, 'amount' AS column_name,
       CAST(count(*) FILTER (WHERE amount IS NOT NULL AND try_cast(amount AS DECIMAL(10,2)) IS NULL) AS BIGINT)
       AS overflow_rows FROM raw_payments
UNION ALL
SELECT 'raw.viewing_activity', 'completion_percentage',
       CAST(count(*) FILTER (WHERE completion_percentage IS NOT NULL
                             AND try_cast(completion_percentage AS DECIMAL(5,2)) IS NULL) AS BIGINT)
FROM raw_viewing""", "raw_payments", "raw_viewing"))
def q_precision(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return precision_summary(raw["payments"], "raw.payments", {"amount": (10, 2)}).unionByName(
        precision_summary(raw["viewing_activity"], "raw.viewing_activity", {"completion_percentage": (5, 2)}))


# The same checks where they find something: on the raw tables.
_RAW_KEYS = {"locations": ["country_id"], "users": ["user_legacy_id"], "watchlist": ["content_id"],
             "payments": ["payment_id"], "viewing_activity": ["session_id"]}
_RAW_NOT_NULL = {"users": ["user_legacy_id", "name", "signup_date"], "watchlist": ["content_id", "genre"],
                 "subscriptions": ["start_date", "end_date"], "payments": ["amount"],
                 "viewing_activity": ["session_start_ts", "rating"]}
_RAW_FKS = [("users", "country_id", "locations", "country_id"), ("payments", "sub_id", "subscriptions", "sub_id"),
            ("viewing_activity", "content_id", "watchlist", "content_id"),
            ("viewing_activity", "device_id", "devices", "device_id")]


def _raw_cte(table: str) -> str:
    return "raw_viewing" if table == "viewing_activity" else f"raw_{table}"


@register("raw_key_violations", O.union_query(
    [O.pk_sql(f"raw.{t}", _raw_cte(t), k) for t, k in _RAW_KEYS.items()], [_raw_cte(t) for t in _RAW_KEYS]))
def q_raw_keys(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return union_all([key_summary(raw[t], f"raw.{t}", k) for t, k in _RAW_KEYS.items()])


@register("raw_null_counts", O.union_query(
    [O.not_null_sql(f"raw.{t}", _raw_cte(t), c) for t, cols in _RAW_NOT_NULL.items() for c in cols],
    [_raw_cte(t) for t in _RAW_NOT_NULL]))
def q_raw_nulls(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return union_all([column_checks(raw[t], f"raw.{t}", cols, {})[0] for t, cols in _RAW_NOT_NULL.items()])


@register("raw_orphans", O.union_query(
    [O.fk_sql(f"raw.{t}", _raw_cte(t), c, f"silver.{p}", f"silver_{p}", pc) for t, c, p, pc in _RAW_FKS],
    [x for t, _, p, _ in _RAW_FKS for x in (_raw_cte(t), f"silver_{p}")]))
def q_raw_orphans(spark, sf_dir):
    b = _b(spark, sf_dir)
    return union_all([orphan_summary(b.raw[t], c, getattr(b, p), pc, f"raw.{t}", f"silver.{p}")
                      for t, c, p, pc in _RAW_FKS])


@register("rejected_rows", O.rejected_rows_sql())
def q_rejected(spark, sf_dir):
    return rejected_rows(_b(spark, sf_dir)).select("source_table", "target_table", "rejection_reason", "row_key")


@register("reject_fields", O.reject_fields_sql())
def q_reject_fields(spark, sf_dir):
    """Fields read out of the payments' reject images by name."""
    r = rejected_rows(_b(spark, sf_dir)).where("source_table = 'raw.payments'")
    field = lambda name, kind: F.variant_get("row_image", f"$.{name}", kind).alias(name)
    return r.select("rejection_reason", field("payment_id", "bigint"), field("user_legacy_id", "string"),
                    field("sub_id", "bigint"), field("amount", "decimal(12,2)"), field("method", "string"))


@register("rejects_replayed", O.rejects_replayed_sql())
def q_rejects_replayed(spark, sf_dir):
    """Payments rejected for a negative amount only, corrected and put through the silver rules again."""
    b = _b(spark, sf_dir)
    rows = replay(rejected_rows(b), "payments").where(F.col("reasons") == F.array(F.lit("amount is negative or missing")))
    fixed = rows.drop("reasons").withColumn("amount", F.abs("amount"))
    return silver.payments(fixed, b.subscriptions)


@register("fact_rejects", O.fact_rejects_sql())
def q_fact_rejects(spark, sf_dir):
    return _b(spark, sf_dir).fact_rejects


@register("mrr_one_year", O.query('SELECT * FROM mrr_by_month_event WHERE "year" = 2019', "mrr_by_month_event"))
def q_mrr_one_year(spark, sf_dir):
    """The report on one year, from facts written by month: only that year's partitions are read."""
    b = Build.from_fixtures(spark, sf_dir, materialized=True)
    return gold.mrr_by_month_event(b.fact_subscription_events, b.dim_date, F.col("year") == 2019)


# Payments dated from here on arrive late in the queries below.
LATE_FROM = "1997-01-01"


@register("late_payments_rebuild", O.table("fact_subscription_events"))
def q_late_payments(spark, sf_dir):
    """Facts from the payments known first, then brought up to date month by month: the full build's rows."""
    raw = _raw(spark, sf_dir)
    is_late = F.coalesce(F.col("payment_date") >= LATE_FROM, F.lit(False))
    early, late_rows = raw["payments"].where(~is_late), raw["payments"].where(is_late)
    w = LayerWriter(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestar-late/{uuid.uuid4().hex}")
    b = Build(spark, raw | {"payments": early}, sink=w)
    build_waves(b, [["lookups", "locations"], ["users", "dim_date"], ["subscriptions"], ["payments", "dim_user"],
                    ["fact_subscription_events"]])
    path = w.path("gold", late.FACT)
    late.rebuild(b, early, late_rows, path)
    return read_facts(spark, path, late.FACT).drop("fact_month")


@register("load_changes", O.query(f"""
SELECT 'raw' AS layer, 'payments' AS table_name, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE NOT coalesce(payment_date >= '{LATE_FROM}', false)) AS BIGINT) AS rows_before,
       CAST(count(*) FILTER (WHERE coalesce(payment_date >= '{LATE_FROM}', false)) AS BIGINT) AS change
FROM raw_payments HAVING change <> 0""", "raw_payments"))
def q_load_changes(spark, sf_dir):
    """Two loads in the audit history, the second with the late payments: the tables whose counts changed."""
    raw = _raw(spark, sf_dir)
    first = raw | {"payments": raw["payments"].where(~F.coalesce(F.col("payment_date") >= LATE_FROM, F.lit(False)))}
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestar-history/{uuid.uuid4().hex}"
    for run_id, tables in (("run-1", first), ("run-2", raw)):
        append_history(spark, root, run_id, audit.row_counts(tables).select(F.lit("raw").alias("layer"), "*"))
    return (load_history(spark, root).where("change <> 0").select("layer", "table_name", "rows", "rows_before", "change"))


# ---- named tables (S12, S13): the documented verification statements as SQL text ----
def _published_gold(spark: SparkSession, sf_dir: str) -> None:
    w = LayerWriter(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestar-published/{uuid.uuid4().hex}", checked=False)
    Build(spark, _raw(spark, sf_dir), DEFAULT_AS_OF, sink=w).gold_tables()
    w.publish()
    register_tables(spark, w.root, {"gold": list(schemas.GOLD)})


@register("sql_fact_count", O.query("SELECT count(*) AS n FROM fact_viewing_activity", "fact_viewing_activity"))
def q_sql_fact_count(spark, sf_dir):
    _published_gold(spark, sf_dir)
    return spark.sql("SELECT COUNT(*) AS n FROM gold.fact_viewing_activity")


@register("sql_dim_sample", O.query("SELECT * FROM dim_user ORDER BY user_key LIMIT 10", "dim_user"))
def q_sql_dim_sample(spark, sf_dir):
    _published_gold(spark, sf_dir)
    return spark.sql("SELECT * FROM gold.dim_user ORDER BY user_key LIMIT 10")


@register("dq_results", O.dq_results_sql())
def q_dq_results(spark, sf_dir):
    q = _quality(spark, sf_dir)
    return dq_results(q["pk"], q["not_null"], q["fk"], q["varchar"])


# ---- verification queries (A4, O1) ----
_GOLD_CTES = ["dim_date", "dim_content", "dim_user", "fact_subscription_events", "fact_viewing_activity"]


@register("table_count", O.query(" UNION ALL ".join(
    f"SELECT 'gold.{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM {t}" for t in _GOLD_CTES), *_GOLD_CTES))
def q_table_count(spark, sf_dir):
    return audit.row_counts({f"gold.{k}": v for k, v in _b(spark, sf_dir).gold_tables().items()})


@register("sample_limit", O.query("SELECT * FROM dim_user ORDER BY user_key LIMIT 10", "dim_user"))
def q_sample_limit(spark, sf_dir):
    return _b(spark, sf_dir).dim_user.orderBy("user_key").limit(10)


# ---- ticketing KPIs (K1-K10) ----
def _kpi_query(name: str, attr: str, oracle_cte: str) -> None:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Ticketing.from_fixtures(spark, sf_dir), attr)
    fn.__name__ = name
    REGISTRY[name] = Entry(fn, O.table(oracle_cte))


@register("ticketing_rejects", O.ticketing_rejects_sql())
def q_ticketing_rejects(spark, sf_dir):
    return ticketing_rejects(Ticketing.from_fixtures(spark, sf_dir)).select(
        "source_table", "target_table", "rejection_reason", "row_key")


for _n, _a, _c in [("silver_artists", "artists", "silver_artists"), ("silver_venues", "venues", "silver_venues"),
                   ("enum_conform", "events", "silver_ticket_events"),
                   ("email_normalised", "customers", "silver_customers"),
                   ("silver_tickets", "tickets", "silver_tickets"),
                   ("silver_checkins", "checkins", "silver_checkins"),
                   ("silver_refunds", "refunds", "silver_refunds"),
                   ("silver_campaigns", "campaigns", "silver_campaigns"),
                   ("event_sales", "event_sales", "event_sales"),
                   ("daily_metrics", "daily_metrics", "daily_metrics"),
                   ("campaign_roi", "campaign_roi", "campaign_roi")]:
    _kpi_query(_n, _a, _c)
