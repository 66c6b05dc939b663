"""Silver and gold rules on tiny literal raw tables (edge cases of the reference)."""

import datetime as dt
from decimal import Decimal

import pytest

from lakestar import schemas
from lakestar.plans import gold
from lakestar.plans.build import Build
from lakestar.plans.kpis import Ticketing
from lakestar.sources.landing import land


def raw(spark, table, rows):
    cols = schemas.RAW[table].fieldNames()
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schemas.RAW[table])


def build(spark, **tables):
    empty = {t: raw(spark, t, []) for t in schemas.RAW_TABLES}
    empty.update({t: raw(spark, t, rows) for t, rows in tables.items()})
    return Build(spark, empty, as_of=dt.date(2023, 1, 1))


LOC = [{"country_id": 1, "country_code": " N1", "country_name": "A ", "region_id": 1, "region_code": "R ",
        "region_name": "R1"},
       {"country_id": 1, "country_code": "Z1", "country_name": "B", "region_id": 1, "region_code": "ZZ",
        "region_name": "R1"}]


def user(uid, legacy, name="ann", country=1, signup=None):
    return {"user_id": uid, "user_legacy_id": legacy, "name": name, "country_id": country, "signup_date": signup}


def test_locations_pick_first_by_raw_code(spark):
    rows = build(spark, locations=LOC).locations.collect()
    assert [(r.country_id, r.country_code, r.country_name) for r in rows] == [(1, "N1", "A")]


def test_users_rules_then_dedupe(spark):
    b = build(spark, locations=LOC, users=[
        user(1, "U1", name="  "),                 # blank name: dropped before dedupe
        user(100000001, "U1", name="zz dup"),     # so the duplicate survives
        user(2, "U2", name=None),
        user(3, "U3", country=999),               # unknown country
        user(4, "U4", name="o'brien-smith mcDONALD", signup="1/5/2024"),
        user(5, "U4", name="later"),
    ])
    got = {r.user_legacy_id: (r.user_id, r.name, r.signup_date) for r in b.users.collect()}
    assert got == {"U1": (100000001, "Zz Dup", None), "U4": (4, "O'Brien-Smith Mcdonald", dt.date(2024, 1, 5))}


def test_subscription_date_rules(spark):
    b = build(spark, locations=LOC, users=[user(1, "U1")], subscriptions=[
        {"sub_id": 1, "user_legacy_id": "U1", "plan_type": "basic", "start_date": "2024-01-05", "end_date": None},
        {"sub_id": 2, "user_legacy_id": "U1", "plan_type": "basic", "start_date": "2024-01-05",
         "end_date": "2024-01-05"},
        {"sub_id": 3, "user_legacy_id": "U1", "plan_type": "basic", "start_date": "2024-01-05",
         "end_date": "2024-01-04"},
        {"sub_id": 4, "user_legacy_id": "U1", "plan_type": "basic", "start_date": None, "end_date": "2024-01-04"},
        {"sub_id": 5, "user_legacy_id": "U1", "plan_type": "basic", "start_date": "2024-01-05",
         "end_date": "2024-02-05 12:00"},
        {"sub_id": 6, "user_legacy_id": " U1", "plan_type": "basic", "start_date": "2024-01-05"},
    ])
    got = {r.sub_id: (r.start_date, r.end_date) for r in b.subscriptions.collect()}
    assert got == {1: (dt.date(2024, 1, 5), None), 2: (dt.date(2024, 1, 5), dt.date(2024, 1, 5)),
                   5: (dt.date(2024, 1, 5), None)}


def test_payments_dedupe_after_amount_rule(spark):
    b = build(spark, locations=LOC, users=[user(1, "U1")],
              subscriptions=[{"sub_id": 9, "user_legacy_id": "U1", "start_date": "2024-01-05"}],
              payments=[{"payment_id": 1, "sub_id": 9, "amount": -1.0}, {"payment_id": 1, "sub_id": 9, "amount": 5.0},
                        {"payment_id": 2, "sub_id": 9, "amount": 0.0}, {"payment_id": 3, "sub_id": 9, "amount": None}])
    got = {r.payment_id: float(r.amount) for r in b.payments.collect()}
    assert got == {1: 5.0, 2: 0.0}


def test_rating_domain_and_fk(spark):
    b = build(spark, locations=LOC, users=[user(1, "U1")],
              watchlist=[{"content_id": 10, "title": "t", "content_type": " movie", "genre": "Drama,X"}],
              devices=[{"device_id": 7, "user_legacy_id": "U1", "device_type": "web"}],
              viewing_activity=[{"session_id": i, "user_legacy_id": "U1", "content_id": 10, "device_id": 7,
                                 "rating": r} for i, r in enumerate([None, 1, 5, 0, 6])] +
                               [{"session_id": 9, "user_legacy_id": "U1", "content_id": 11, "device_id": 7}])
    assert sorted(r.session_id for r in b.viewing_activity.collect()) == [0, 1, 2]


def test_latest_subscription_null_start_wins_and_active_flag(spark):
    b = build(spark, locations=LOC, users=[user(1, "U1"), user(2, " U2"), user(3, "U3"), user(4, "U4")],
              subscriptions=[
                  {"sub_id": 1, "user_legacy_id": "U1", "plan_type": "gold", "start_date": None, "end_date": None},
                  {"sub_id": 2, "user_legacy_id": "U1", "plan_type": "basic", "start_date": "2024-01-01",
                   "end_date": "2024-06-01"},
                  {"sub_id": 3, "user_legacy_id": "U3", "plan_type": "basic", "start_date": "2022-01-01",
                   "end_date": "2023-01-01"},
                  {"sub_id": 4, "user_legacy_id": "U4", "plan_type": "basic", "start_date": "2022-01-01",
                   "end_date": "2023-06-01"}])
    got = {r.user_key: (r.current_plan_type, r.is_active, r.first_subscription_date) for r in b.dim_user.collect()}
    assert got == {"U1": ("Gold", True, dt.date(2024, 1, 1)), "U2": (None, True, None),
                   "U3": ("Basic", False, dt.date(2022, 1, 1)), "U4": ("Basic", True, dt.date(2022, 1, 1))}


def test_facts_drop_dates_outside_calendar_and_trim_ids(spark):
    b = build(spark, locations=LOC, users=[user(1, " U1")],
              subscriptions=[{"sub_id": s, "user_legacy_id": " U1", "last_event_type": "renew", "start_date": d}
                             for s, d in [(1, "2017-12-31"), (2, "2026-01-01"), (3, None), (4, "2024-05-05")]],
              payments=[{"payment_id": p, "user_legacy_id": "U1", "sub_id": p, "amount": 10.0} for p in (1, 2, 3, 4)],
              devices=[{"device_id": 1, "user_legacy_id": "U1"}, {"device_id": 2, "user_legacy_id": " U1"}])
    facts = b.fact_subscription_events.collect()
    assert [(r.date_key, r.user_key, r.event_type_name) for r in facts] == [(20240505, "U1", "RENEW")]
    assert [r.device_id for r in b.devices.collect()] == [2]


def test_dim_date_calendar(spark):
    d = gold.dim_date(spark)
    assert d.count() == 2922
    r = d.where("full_date = date'2024-05-05'").first()
    assert (r.date_key, r.day_of_week, r.is_weekend, r.month_name, r.quarter) == (20240505, 7, True, "May", 2)


def test_all_null_rows_dropped(spark):
    df = raw(spark, "users", [{}, {"user_id": 1}])
    assert land(df).count() == 1


def test_lookups_drop_unmatched_and_number_by_name(spark):
    b = build(spark, devices=[{"device_id": i, "device_type": t} for i, t in
                              enumerate(["web", "console", " mobile-x", "tablet"])])
    got = [(r.device_type_id, r.device_type_name) for r in b.lk("dim_device_types").orderBy("device_type_id").collect()]
    assert got == [(1, "Mobile"), (2, "Tablet"), (3, "Web")]


def test_kpi_ratios_null_on_zero_divisor(spark):
    rows = {
        "venues": spark.createDataFrame([(1, "v", "0"), (2, "w", "100")], "venue_id int, name string, capacity string"),
        "events": spark.createDataFrame([(1, 1, 1, "2024-01-01", "x", "1.0"), (2, 1, 2, "2024-01-01", "x", "1.0")],
                                        "event_id long, artist_id int, venue_id long, event_date string, "
                                        "status string, ticket_price string"),
        "customers": spark.createDataFrame([(1, "c", " A@B.C ")], "customer_id long, name string, email string"),
        "tickets": spark.createDataFrame([(1, 2, 1, dt.datetime(2024, 1, 1), "web", Decimal("10"))],
                                         "ticket_id long, event_id long, customer_id long, "
                                         "purchase_datetime timestamp_ntz, channel string, price_paid decimal(12,2)"),
        "checkins": spark.createDataFrame([], "checkin_id long, event_id long, ticket_id long"),
        "refunds": spark.createDataFrame([], "refund_id long, ticket_id long, event_id long, "
                                             "refund_amount decimal(12,2), refunded_at timestamp_ntz"),
        "campaigns": spark.createDataFrame([(1, 1, "web", Decimal("0")), (2, 2, "tv", Decimal("5"))],
                                           "campaign_id long, event_id long, channel string, spend decimal(12,2)"),
    }
    k = Ticketing(rows)
    es = {r.event_id: (r.tickets_sold, r.no_show_rate, r.sell_through) for r in k.event_sales.collect()}
    assert es == {1: (0, None, None), 2: (1, 1.0, 0.01)}
    roi = {r.event_id: (r.cpa, r.roi) for r in k.campaign_roi.collect()}
    assert roi == {1: (None, None), 2: (None, -1.0)}
    assert k.customers.first().email == "a@b.c"


@pytest.mark.parametrize("name", ["dim_genres", "silver_users", "silver_payments", "dim_user",
                                  "fact_subscription_events", "fact_viewing_activity", "rejected_rows",
                                  "event_sales", "mrr_by_month_event", "latest_subscription"])
def test_registered_query_matches_oracle(spark, name):
    import duckdb

    import __spark_entry__ as E
    from tools.oracle_check import TABLES, rows
    from tests.conftest import SMALL_SF
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    s = E.queries()[name](spark, SMALL_SF).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert rows(s) == rows(d)


def test_rejects_carry_reason_key_and_row_image(spark):
    import json

    from lakestar.plans.rejects import rejected_rows
    b = build(spark, locations=LOC, users=[user(1, "U1"), user(2, "U2", name=" ", country=999),
                                           user(3, "U3", signup="02/30/2024")])
    got = {(r.row_key, r.rejection_reason): r.row_data for r in rejected_rows(b).collect()}
    assert set(got) == {("2", "name is blank"), ("2", "country_id not in locations"),
                        ("3", "signup_date is not a valid date")}
    assert json.loads(got[("3", "signup_date is not a valid date")])["signup_date"] == "02/30/2024"
    assert [r.signup_date for r in b.users.where("user_id = 3").collect()] == [None]   # kept, value nulled


def test_artists_dedupe_and_campaign_dates(spark):
    artists = spark.createDataFrame([(1, " Ann ", "rock", "NL", "2024-01-05"), (1, "Bob", "pop", "NL", None),
                                     (2, "Cy", "jazz", "US", "1/5/2024")],
                                    "artist_id long, name string, genre string, country string, created_at string")
    events = spark.createDataFrame([(1, 1, 1, "2024-01-01", "scheduled", "1.0")],
                                   "event_id long, artist_id long, venue_id long, event_date string, status string, "
                                   "ticket_price string")
    campaigns = spark.createDataFrame([(1, 1, " Web ", Decimal("5"), "2024-02-01", "02/30/2024")],
                                      "campaign_id long, event_id long, channel string, spend decimal(12,2), "
                                      "start_date string, end_date string")
    k = Ticketing({"artists": artists, "events": events, "campaigns": campaigns})
    got = {r.artist_id: (r.name, r.created_at) for r in k.artists.collect()}
    assert got == {1: ("Ann", dt.date(2024, 1, 5)), 2: ("Cy", dt.date(2024, 1, 5))}
    c = k.campaigns.first()
    assert (c.channel, c.start_date, c.end_date) == ("web", dt.date(2024, 2, 1), None)
