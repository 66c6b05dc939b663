"""Full run on the smallest tables: every layer written, checks pass, run published."""

import tempfile

from lakestar.plans import pipeline
from lakestar.sources.fixtures import Fixtures
from lakestar.sources.landing import read_raw_set
from lakestar.sources.sinks import read_published
from tests.conftest import SMALL_SF

CSV_OPTS = dict(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def test_pipeline_publishes_after_checks(spark):
    root = tempfile.mkdtemp(prefix="lakestar-test-")
    rep = pipeline.run(spark, Fixtures(spark, SMALL_SF).raw(), root)
    assert rep.published and rep.failed_checks == 0
    assert read_published(spark, root, "gold", "dim_date").count() == 2922
    users = read_published(spark, root, "silver", "users").count()
    assert read_published(spark, root, "gold", "dim_user").count() == users
    dq = read_published(spark, root, "audit", "dq_results")
    assert dq.where("NOT passed").count() == 0


def test_raw_set_reader_round_trip_csv(spark):
    src = tempfile.mkdtemp(prefix="lakestar-raw-")
    fx = Fixtures(spark, SMALL_SF)
    fx.users.write.options(**CSV_OPTS).csv(f"{src}/users.csv")
    got = read_raw_set(spark, src, "csv")
    assert list(got) == ["users"]                      # missing tables are skipped
    assert {t for _, t in got["users"].dtypes} == {"string"}   # bronze holds the text as read
    cols = ["user_id", "user_legacy_id", "name", "age", "country_id", "signup_date"]
    from lakestar import schemas
    from lakestar.functions.conform import typed
    got["users"] = typed(got["users"], schemas.RAW["users"])
    as_rows = lambda df: sorted(map(tuple, df.select(cols).collect()), key=repr)
    assert as_rows(got["users"]) == as_rows(fx.users)          # values land in their own columns


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_ticketing_run_from_csv_inputs(spark):
    from lakestar.plans.kpis import Ticketing
    src = tempfile.mkdtemp(prefix="lakestar-tix-")
    fx = Fixtures(spark, SMALL_SF)
    frames = {"venues": fx.venues, "events": fx.ticket_events, "customers": fx.customers, "tickets": fx.tickets,
              "checkins": fx.checkins, "refunds": fx.refunds, "campaigns": fx.campaigns}
    for name, df in frames.items():
        df.write.options(**CSV_OPTS).csv(f"{src}/{name}.csv")
    landed = read_raw_set(spark, src, "csv", domain="ticketing")
    assert sorted(landed) == sorted(frames)             # artists absent: skipped
    root = tempfile.mkdtemp(prefix="lakestar-tixrun-")
    rep = pipeline.run_ticketing(spark, landed, root)
    assert rep.published and rep.failed_checks == 0
    expected = Ticketing(frames).event_sales
    got = read_published(spark, root, "gold", "event_sales")
    cols = ["event_id", "tickets_sold", "attendance", "gross_revenue", "refunds_amount"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, expected.select(cols).collect()))


def test_writer_append_and_publish_flip(spark):
    from lakestar.sources.sinks import LayerWriter, append, published_run
    root = tempfile.mkdtemp(prefix="lakestar-flip-")
    first = LayerWriter(spark, root, "run1")
    first("gold", "t", spark.range(3))
    first.publish()
    second = LayerWriter(spark, root, "run2")
    second("gold", "t", spark.range(5))
    assert published_run(spark, root) == "run1"          # an unpublished run is invisible
    assert read_published(spark, root, "gold", "t").count() == 3
    append(spark.range(2), second.path("gold", "t"))
    second.publish()
    assert published_run(spark, root) == "run2"
    assert read_published(spark, root, "gold", "t").count() == 7
    assert [s.rows for s in second.stats] == [5]          # rows counted while writing


def test_pipeline_results_do_not_depend_on_join_strategy(spark):
    """Broadcast or shuffled parents: the same tables are written, with the same rows."""
    from tests.test_scale import with_conf
    raw = Fixtures(spark, SMALL_SF).raw()
    roots = {}

    def run(kind):
        roots[kind] = tempfile.mkdtemp(prefix=f"lakestar-{kind}-")
        return pipeline.run(spark, raw, roots[kind])

    small = run("broadcast")
    big = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, lambda: run("shuffled"))
    assert big.published and small.published and big.rows == small.rows
    assert {k for k in big.rows if k.endswith("_fk_checked")} == {
        f"bronze.{t}_fk_checked" for t in ["users", "devices", "subscriptions", "payments", "viewing_activity"]}
    for layer, table in [k.split(".") for k in big.rows if k.startswith(("silver.", "gold."))]:
        a, b = (read_published(spark, roots[k], layer, table) for k in roots)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), table


def test_missing_raw_table_counts_as_empty(spark):
    raw = Fixtures(spark, SMALL_SF).raw()
    del raw["watchlist"]
    root = tempfile.mkdtemp(prefix="lakestar-missing-")
    rep = pipeline.run(spark, raw, root)
    assert rep.rows["silver.watchlist"] == 0 and rep.rows["silver.viewing_activity"] == 0
    assert rep.rows["silver.payments"] > 0


def test_daily_net_adds_up_with_tickets_of_unknown_day(spark):
    from pyspark.sql import functions as F

    from lakestar.plans.kpis import Ticketing
    fx = Fixtures(spark, SMALL_SF)
    tickets = fx.tickets.withColumn("purchase_datetime", F.when(F.col("ticket_id") % 3 > 0, F.col("purchase_datetime")))
    k = Ticketing({"venues": fx.venues, "events": fx.ticket_events, "customers": fx.customers, "tickets": tickets,
                   "checkins": fx.checkins, "refunds": fx.refunds, "campaigns": fx.campaigns})
    by_day = k.daily_metrics.agg(F.sum("net_revenue")).first()[0]
    by_event = k.event_sales.agg(F.sum("net_revenue")).first()[0]
    assert by_day == by_event
    assert k.daily_metrics.where("date is null").count() == 1


def test_texts_that_do_not_fit_become_rejects(spark):
    """No bad cell and no row goes unseen: the raw text stays in bronze, the cast failure in the rejects."""
    from pyspark.sql import functions as F

    from lakestar import schemas
    from lakestar.functions.conform import as_text
    raw = {t: as_text(df, schemas.RAW[t].names) for t, df in Fixtures(spark, SMALL_SF).raw().items()}
    some = raw["viewing_activity"].columns
    bad = spark.createDataFrame(
        [("x9", "U1", "1", "1", "2020-01-01", "10", "1.5", "3"), ("900001", "U1", "1", "1", None, "ten", "1.5", "abc"),
         ("900002", "U1", "1", "1", None, "7", "123456.5", None), tuple([None] * 8)], ", ".join(f"{c} string" for c in some))
    raw["viewing_activity"] = raw["viewing_activity"].unionByName(bad)
    root = tempfile.mkdtemp(prefix="lakestar-casts-")
    rep = pipeline.run(spark, raw, root)
    landed = read_published(spark, root, "bronze", "viewing_activity")
    assert {t for _, t in landed.dtypes} == {"string"}
    assert rep.rows["bronze.viewing_activity"] == raw["viewing_activity"].count() - 1     # the all-NULL row only
    rejected = read_published(spark, root, "audit", "rejected_rows").where("source_table = 'raw.viewing_activity'")
    got = {(r.row_key, r.rejection_reason) for r in rejected.where(
        F.col("row_key").isin("x9", "900001", "900002") | F.col("row_key").isNull()).collect()}
    assert {("x9", "session_id is not a valid bigint"), ("900001", "duration_watched_sec is not a valid int"),
            ("900001", "rating is not a valid int"), (None, "session_id is null"),
            ("900002", "completion_percentage does not fit numeric(5,2)")} <= got
    assert "ten" in rejected.where("row_key = '900001'").first().row_data
