"""Facts with their lost rows, month layout, late payments, one-pass checks, named tables, histories, rejects."""

import tempfile

import pytest
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions.conform import as_text
from lakestar.operators import quality
from lakestar.operators.joins import materialize
from lakestar.plans import gold, late, pipeline, silver
from lakestar.plans.build import Build, Kept
from lakestar.plans.rejects import MALFORMED, rejected_rows, replay
from lakestar.sources import sinks
from lakestar.sources.fixtures import Fixtures
from lakestar.sources.landing import read_raw_set
from tests.conftest import SMALL_SF


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def written(spark):
    """A small build whose tables are written, facts by month."""
    w = sinks.LayerWriter(spark, tempfile.mkdtemp(prefix="lakestar-facts-"))
    b = Build.from_fixtures(spark, SMALL_SF)
    b.sink = w
    b.gold_tables()
    w.publish()
    return b, w


def test_facts_and_lost_rows_add_up(written):
    b, w = written
    for name, source in (("fact_subscription_events", b.payments), ("fact_viewing_activity", b.viewing_activity)):
        fact, star = getattr(b, name), b.star(name)
        lost = gold.lost(star, name)
        n_lost = lost.agg(F.sum("lost_rows")).first()[0]
        assert fact.count() + n_lost == source.count() == star.count() and n_lost > 0 and fact.count() > 0
        assert w.observed["gold", name]["kept_rows"] == fact.count()
        assert star.where("kept = (lost_reason IS NOT NULL)").count() == 0
        assert star.select("source_key").distinct().count() == star.count()
        assert star.where("kept AND fact_month <> date_key div 100").count() == 0
    assert {r.fact_table for r in b.fact_rejects.collect()} == {"gold.fact_subscription_events", "gold.fact_viewing_activity"}


def test_every_failed_lookup_is_named(spark):
    user = spark.createDataFrame([("U1",)], "user_key string")
    day = spark.createDataFrame([(20200105, "2020-01-05")], "date_key int, d string").select("date_key", F.to_date("d").alias("full_date"))
    kinds = spark.createDataFrame([(1, "SIGNUP")], "event_type_id int, event_type_name string")
    subs = spark.createDataFrame([(1, "2020-01-05", 1), (2, None, 1), (3, "2031-01-01", 1), (4, "2020-01-05", 9)],
                                 "sub_id long, s string, last_event_type_id int").select(
        "sub_id", F.to_date("s").alias("start_date"), "last_event_type_id")
    pay = spark.createDataFrame([(10, 1, " U1"), (11, 1, "U2"), (12, 1, None), (13, 2, "U1"), (14, 3, "U1"), (15, 4, "U1"), (16, 9, "U2")],
                                "payment_id long, sub_id long, user_legacy_id string").withColumn("amount", F.lit(2.5).cast("decimal(10,2)"))
    star = gold.star_subscription_events(pay, subs, user, day, kinds)
    got = {r.source_key: (r.lost_reason, r.lost_key, r.fact_month) for r in star.collect()}
    assert got == {"10": (None, None, 202001), "11": ("user is not in dim_user", "U2", 202001),
                   "12": ("user is not in dim_user", "NULL", 202001), "13": ("start date is not in dim_date", "NULL", 0),
                   "14": ("start date is not in dim_date", "2031-01-01", 0), "15": ("subscription has no event type", "4", 202001),
                   "16": ("subscription is not in silver", "9", 0)}
    plan = gold.facts(star, "fact_subscription_events")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" not in plan        # facts alone are inner joins


def test_a_dated_report_reads_its_months_only(written):
    b, _ = written
    fact = b.fact_subscription_events
    year = gold.mrr_by_month_event(fact, b.dim_date, F.col("year") == 2019)
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.split("PartitionFilters")[1]
    assert rows_of(year) == rows_of(gold.mrr_by_month_event(fact, b.dim_date).where("year = 2019")) and not year.isEmpty()
    one = fact.where("fact_month = 201905")
    months = {f.split("fact_month=")[1].split("/")[0] for f in fact.inputFiles()}
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert len(months) > 12 and "fact_month" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_late_payments_rewrite_touched_months_only(spark):
    raw = Fixtures(spark, SMALL_SF).raw()
    w = sinks.LayerWriter(spark, tempfile.mkdtemp(prefix="lakestar-late-"))
    cut = F.col("payment_id").isin([r.payment_id for r in raw["payments"].where("amount > 0").orderBy(
        F.desc("payment_date"), "payment_id").limit(3).collect()])          # three payments come late
    early, tail = raw["payments"].where(~cut), raw["payments"].where(cut)
    b = Build(spark, raw | {"payments": early}, sink=w)
    b.fact_subscription_events  # noqa: B018
    path = w.path("gold", late.FACT)
    before = set(sinks.read_facts(spark, path, late.FACT).inputFiles())
    # one month's only payments move to a lost row: a better row of the same ids names a subscription without a start
    starts = b.subscriptions.join(tail, "sub_id").select(F.date_format("start_date", "yyyyMM").cast("int").alias("fact_month"))
    counts = sinks.read_facts(spark, path, late.FACT).groupBy("fact_month").count().join(starts, "fact_month", "left_anti")
    month = counts.orderBy("count", "fact_month").first().fact_month
    ids = spark.read.schema(schemas.star_schema(late.FACT)).parquet(path).where(f"kept AND fact_month = {month}").select(
        F.col("source_key").cast("long").alias("payment_id"))
    nowhere = b.subscriptions.where("start_date IS NULL").agg(F.min("sub_id")).first()[0]
    moved = materialize(early.join(ids, "payment_id", "left_semi").withColumns({     # its ids come from files that go
        "sub_id": F.lit(nowhere).cast("long"), "amount": F.lit(0.0)}).select(*early.columns))
    late_rows = tail.unionByName(moved)
    months = late.rebuild(b, early, late_rows, path)
    got = sinks.read_facts(spark, path, late.FACT)
    full = Build(spark, raw | {"payments": raw["payments"].unionByName(moved)}, sink=Kept())
    assert rows_of(got) == rows_of(full.fact_subscription_events)
    assert month in months and got.where(f"fact_month = {month}").isEmpty()     # an emptied month is gone
    kept = before & set(got.inputFiles())
    untouched = {f for f in before if int(f.split("fact_month=")[1].split("/")[0]) not in months}
    assert untouched and kept == untouched                                       # other months' files are the same files
    lost = spark.read.schema(schemas.star_schema(late.FACT)).parquet(path).where("NOT kept").drop("fact_month")
    assert rows_of(lost) == rows_of(full.star(late.FACT).where("NOT kept").drop("fact_month"))
    assert late.rebuild(b, early, late_rows.limit(0), path) == []


def exchanges(df):
    return df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_checks_take_one_pass(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (None, None), (3, "c")], "id int, name string")
    got = quality.key_summaries(df, "t", [["id"], ["name"], ["id", "name"]])
    plan, n = exchanges(got)
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1 and n == 2
    assert rows_of(got) == rows_of(quality.union_all([quality.key_summary(df, "t", k) for k in (["id"], ["name"], ["id", "name"])]))
    kids = [(spark.createDataFrame([(1,), (7,), (7,), (None,)], "p int"), "p", "c1"),
            (spark.createDataFrame([(2,), (9,)], "q int"), "q", "c2"), (spark.createDataFrame([], "z int"), "z", "c3")]
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    both = quality.orphan_summaries(kids, parent, "id", "p")
    assert exchanges(both)[1] == 2             # however many relations the parent has
    assert rows_of(both) == rows_of(quality.union_all([quality.orphan_summary(c, col, parent, "id", n, "p") for c, col, n in kids]))


def test_row_checks_are_observed_not_read(spark):
    b = Build.from_fixtures(spark, SMALL_SF, materialized=True)
    q = pipeline.quality_frames(b)
    for kind in ("not_null", "varchar"):
        plan = q[kind]._jdf.queryExecution().executedPlan().toString()
        assert "parquet" not in plan.lower()
    plain = quality.column_checks(b.users, "silver.users", list(schemas.SILVER["users"].not_null), dict(schemas.SILVER["users"].varchar))
    for kind, df in zip(("not_null", "varchar"), plain, strict=True):
        assert rows_of(q[kind].where("table_name = 'silver.users'")) == rows_of(df)
    fks = q["fk"]._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    relations = sum(len(t.fks) for t in [*schemas.SILVER.values(), *schemas.GOLD.values()])
    parents = len({f[1] for t in schemas.SILVER.values() for f in t.fks}) + len({f[1] for t in schemas.GOLD.values() for f in t.fks})
    assert fks <= 2 * parents < 2 * relations
    amounts = b.observed["bronze", "payments_fk_checked"]["np__amount"]
    assert amounts == b.raw["payments"].where("amount IS NOT NULL AND try_cast(amount AS decimal(10,2)) IS NULL").count()


def test_published_tables_have_names(spark, written):
    b, w = written
    names = sinks.register_tables(spark, w.root)
    assert {"gold.fact_viewing_activity", "gold.dim_user", "silver.users"} <= set(names)
    assert spark.sql("SELECT COUNT(*) AS n FROM gold.fact_viewing_activity").first().n == b.fact_viewing_activity.count()
    assert len(spark.sql("SELECT * FROM gold.dim_user LIMIT 10").collect()) == 10
    plan = spark.sql("SELECT * FROM gold.fact_subscription_events WHERE fact_month = 201905")._jdf.queryExecution().executedPlan().toString()
    assert "fact_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    again = sinks.LayerWriter(spark, w.root)
    for t in schemas.GOLD:
        star = t in schemas.FACTS
        df = spark.createDataFrame([], schemas.star_schema(t) if star else schemas.GOLD[t].schema)
        again("gold", t, df, layout=schemas.LAYOUT if star else ())
    again.publish()
    sinks.register_tables(spark, w.root, {"gold": list(schemas.GOLD)})           # names follow the published run
    assert spark.sql("SELECT * FROM gold.fact_viewing_activity").isEmpty()
    assert spark.sql("SELECT * FROM gold.dim_user").isEmpty()


def test_history_names_what_changed(spark):
    root = tempfile.mkdtemp(prefix="lakestar-history-")
    schema, checks = "layer string, table_name string, rows long, run_id string", (
        "check_name string, table_name string, column_name string, violations long, passed boolean")
    for run, n, bad in (("r1", 5, 0), ("r2", 5, 2), ("r3", 9, 2)):
        loads = spark.createDataFrame([("silver", "users", n, run), ("silver", "devices", 3, run)], schema)
        sinks.append_history(spark, root, run, loads, spark.createDataFrame([("not_null", "silver.users", "id", bad, bad == 0)], checks))
    got = sinks.load_history(spark, root)
    assert [(r.run_id, r.table_name, r.rows_before, r.change) for r in got.where("change <> 0").collect()] == [("r3", "users", 5, 4)]
    assert got.where("rows_before IS NULL").count() == 2
    assert [r.run_id for r in sinks.check_history(spark, root).where("violations > violations_before").collect()] == ["r2"]


def test_rejects_have_ids_and_fields_and_can_be_replayed(spark):
    raw = Fixtures(spark, SMALL_SF).raw()
    raw["payments"] = raw["payments"].union(
        spark.createDataFrame([(-1, "U1", None, -3.5, "x", "cash")] * 3, raw["payments"].schema))
    b = Build(spark, raw)
    rejects = rejected_rows(b)
    mine = rejects.where("source_table = 'raw.payments' AND row_key = '-1'")
    assert sorted((r.rejection_reason, r.occurrence) for r in mine.collect()) == sorted(
        (why, k) for why in ("amount is negative or missing", "sub_id not in subscriptions") for k in (1, 2, 3))
    assert rejects.select("rejection_id").distinct().count() == rejects.count()
    ids = {r.rejection_id for r in mine.collect()}
    assert ids == {r.rejection_id for r in rejected_rows(Build(spark, raw)).where("row_key = '-1'").collect()}   # every run alike
    assert {r[0] for r in mine.select(F.variant_get("row_image", "$.amount", "double")).collect()} == {-3.5}
    back = replay(rejects, "payments")
    assert back.where("payment_id = -1").count() == 3
    rows = back.where(F.col("reasons") == F.array(F.lit("amount is negative or missing"))).drop("reasons")
    fixed = silver.payments(rows.withColumn("amount", F.abs("amount")), b.subscriptions)
    expected = silver.payments(raw["payments"].where("amount < 0").withColumn("amount", F.abs("amount")), b.subscriptions)
    assert rows_of(fixed) == rows_of(expected) and fixed.count() > 0


def test_malformed_lines_become_rejects(spark):
    src = tempfile.mkdtemp(prefix="lakestar-lines-")
    head = "payment_id,user_legacy_id,sub_id,amount,payment_date,method"
    good = ['1,U1,5,2.5,2020-01-01T00:00:00.000001Z,cash', '2,U1,5,3.5,x,"a ""quoted"" cell"', '3,U1,five,1,,']
    bad = ['4,U1,5', '5,U1,5,2,x,cash,more', '6,"U1,5,2,x,cash', '7,"U1" x,5,2,x,cash']
    with open(f"{src}/payments.csv", "w") as f:
        f.write("\n".join([head, *good, *bad, ",,,,,"]) + "\n")
    landed = read_raw_set(spark, src, "csv")["payments"]
    assert landed.count() == len(good) + len(bad)                       # the all-empty line is dropped
    raw = {t: as_text(spark.createDataFrame([], s), s.names) for t, s in schemas.RAW.items() if t in schemas.SUBSCRIPTION_TABLES}
    b = Build(spark, raw | {"payments": landed})
    assert {r.payment_id for r in b.raw["payments"].collect()} == {1, 2, 3}
    assert {r.method for r in b.raw["payments"].collect()} == {"cash", 'a "quoted" cell', None}
    rejects = rejected_rows(b).where("source_table = 'raw.payments'")
    lines = rejects.where(F.col("rejection_reason") == MALFORMED)
    assert sorted(r[0] for r in lines.select(F.variant_get("row_image", "$.line", "string")).collect()) == sorted(bad)
    assert {r.target_table for r in lines.collect()} == {"bronze.payments"}
    told = {(r.row_key, r.rejection_reason) for r in rejects.collect()}
    assert ("3", "sub_id is not a valid bigint") in told and not any(k in {"4", "5", "6", "7"} for k, _ in told)
    assert replay(rejects, "payments").count() == 3


def test_an_empty_source_is_written_and_counted(spark):
    """A documented deviation: the empty table is written (not skipped), and its zero is in the audit."""
    from lakestar.sources.landing import land
    w = sinks.LayerWriter(spark, tempfile.mkdtemp(prefix="lakestar-none-"))
    empty = as_text(spark.createDataFrame([tuple([None] * 6)], schemas.RAW["payments"]), schemas.RAW["payments"].names)
    assert w("bronze", "payments", land(empty)).count() == 0             # an all-NULL row is no row
    assert w.stats_frame().first().rows == 0
