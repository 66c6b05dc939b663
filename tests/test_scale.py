"""Plan-shape guarantees that matter at scale: hot keys, sizing, shared folders."""

from pyspark.sql import functions as F

from lakestar.operators.joins import materialize, semi
from lakestar.session import cluster_conf


def with_conf(spark, conf: dict, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_semi_join_is_split_by_aqe(spark):
    def run():
        hot = spark.range(60000).select(F.lit("HOT").alias("k"), F.col("id").alias("v"))
        cold = spark.range(120000).select((F.col("id") % 5000).cast("string").alias("k"), F.col("id").alias("v"))
        child = materialize(hot.unionByName(cold))            # one key holds a third of the rows
        parent = materialize(spark.range(5000).select(F.col("id").cast("string").alias("k"))
                             .unionByName(spark.range(1).select(F.lit("HOT").alias("k"))))
        out = semi(child, parent, "k").select("v")
        assert len(out.collect()) == 180000                  # whole result, nothing dropped
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in final or "skew=true" in final
    with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                      "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
                      "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                      "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
                      "spark.sql.adaptive.coalescePartitions.enabled": "false"}, run)


def test_hot_user_is_split_on_the_pipelines_own_parent(spark):
    """Subscriptions of one user hold a third of the rows; the join to the written silver users is split."""
    from pyspark.sql import types as T

    from lakestar.plans import silver
    from lakestar.plans.build import Build
    from lakestar.sources.fixtures import Fixtures
    from tests.conftest import SMALL_SF

    def run():
        raw = Fixtures(spark, SMALL_SF).raw()
        b = Build(spark, raw, sink=lambda layer, name, df: materialize(df))
        hot = b.users.select("user_legacy_id").orderBy("user_legacy_id").limit(1).first()[0]
        many = spark.range(60000).select(F.lit(hot).alias("user_legacy_id"), F.col("id").alias("sub_id"))
        rest = spark.range(120000).select(F.concat(F.lit("x"), (F.col("id") % 5000).cast("string")).alias("user_legacy_id"),
                                          (F.col("id") + 60000).alias("sub_id"))
        subs = many.unionByName(rest)
        for f in raw["subscriptions"].schema:
            if f.name not in subs.columns:
                subs = subs.withColumn(f.name, F.lit(None).cast(T.StringType()).cast(f.dataType))
        subs = materialize(subs.select(*raw["subscriptions"].columns))
        out = silver.check_fks("subscriptions", subs, {"users": b.users})
        rows = out.collect()
        assert len(rows) == 180000 and sum(r["__in_users"] is True for r in rows) == 60000
        return out._jdf.queryExecution().executedPlan().toString()

    plan = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
                             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
                             "spark.sql.adaptive.coalescePartitions.enabled": "false"}, run)
    assert "isSkewJoin=true" in plan or "skew=true" in plan


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    import pytest

    from lakestar import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_cluster_conf_sizes_partitions_to_input():
    c = cluster_conf(100 * (1 << 40))
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(1 << 20)["spark.sql.shuffle.partitions"]) == 200


def test_results_do_not_depend_on_session_time_zone(spark):
    import __spark_entry__ as E
    from tests.conftest import SMALL_SF

    def run():
        return sorted(map(tuple, E.queries()["silver_viewing_activity"](spark, SMALL_SF).collect()), key=repr)
    utc = run()
    other = with_conf(spark, {"spark.sql.session.timeZone": "America/Los_Angeles"}, run)
    assert utc == other and len(utc) > 0


PAYMENTS = [(1, "U1", 1, -5.0, "2024-01-05T10:11:12.123456Z", "cash"), (1, "U1", 1, -5.0, "2024-01-05T10:11:12.123456Z", "cash"),
            (2, "U1", 7, -1.0, "2024-13-45T10:11:12.123456Z", "cash"), (None, "U1", 1, 3.0, None, None), (4, "U2", 1, 2.0, None, "card")]


def checked_payments(spark):
    from lakestar import schemas

    rows = spark.createDataFrame(PAYMENTS, schemas.RAW["payments"])
    return rows.join(spark.createDataFrame([(1, True)], "sub_id long, __in_subscriptions boolean"), "sub_id", "left").select(
        *rows.columns, "__in_subscriptions")


def test_reject_rules_are_compiled(spark):
    from lakestar.plans.rejects import _rejects

    df = checked_payments(spark)
    got = _rejects("payments", df, "payment_id", [("no id", F.col("payment_id").isNull()), ("low", F.col("amount") < 0)],
                   df.columns)
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()  # Spark interprets these for every row
    assert sorted((r.rejection_reason, r.row_key or "") for r in got.collect()) == [
        ("low", "1"), ("low", "1"), ("low", "2"), ("no id", "")]


def test_replayed_conditions_stay_above_the_images(spark):
    from lakestar.plans.rejects import _numbered, _rejects, replay

    df = checked_payments(spark)
    rules = [("low", F.col("amount") < 0), ("orphan", F.col("__in_subscriptions").isNull())]
    back = replay(_numbered(_rejects("payments", df, "payment_id", rules, df.columns[:-1])), "payments")
    kept = back.where(F.col("payment_id").isNotNull() & (F.abs("amount") >= 0))
    joins = [x for x in kept._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x or "Relation" in x]
    assert joins and not any("variant_get" in x for x in joins)
    assert sorted((r.payment_id, r.amount, r.reasons) for r in kept.collect()) == [
        (1, -5.0, ["low"]), (1, -5.0, ["low"]), (2, -1.0, ["low", "orphan"])]


def test_checks_write_no_table_that_is_read_once(spark, monkeypatch):
    from lakestar import catalog
    from lakestar.plans import build

    seen = []

    class Noted(build.Kept):
        def __call__(self, layer, name, df, metrics=None, layout=()):
            out = super().__call__(layer, name, df, metrics, layout)
            seen.append((layer, name, out is df))
            return out

    monkeypatch.setattr(catalog, "Kept", Noted, raising=False)
    monkeypatch.setattr(build, "Kept", Noted)
    found = catalog._quality(spark, "/root/testdata/sf0.001")
    assert {n for layer, n, _ in seen if layer == "bronze"} == {
        f"{t}_fk_checked" for t in ("users", "devices", "subscriptions", "payments", "viewing_activity")}
    assert all(lazy == (layer == "bronze") for layer, _, lazy in seen)
    assert set(found) == {"pk", "not_null", "fk", "varchar"} and not found["varchar"].isEmpty()


def test_late_rows_are_read_once(spark, tmp_path):
    from lakestar.plans import late
    from lakestar.plans.build import Build
    from lakestar.sources import sinks
    from lakestar.sources.fixtures import Fixtures

    raw = Fixtures(spark, "/root/testdata/sf0.001").raw()
    is_late = F.coalesce(F.col("payment_date") >= "1997-01-01", F.lit(False))
    early, tail = raw["payments"].where(~is_late), raw["payments"].where(is_late)
    w = sinks.LayerWriter(spark, str(tmp_path))
    b = Build(spark, raw | {"payments": early}, sink=w)
    b.fact_subscription_events  # noqa: B018
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for x in batches:
            read.add(x.num_rows)
            yield x

    rows = materialize(early)
    late.rebuild(b, rows.mapInArrow(counted, rows.schema), tail, w.path("gold", late.FACT))
    assert read.value == rows.count()


def test_sides_that_grow_are_not_broadcast_whatever_their_files_take(spark):
    from lakestar.plans import gold, silver

    def frame(ddl: str, *rows):
        return materialize(spark.createDataFrame(list(rows), ddl))   # written: Catalyst knows how small it is

    def parents(df, kind):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        return plan.count(kind)

    users = frame("user_legacy_id string, country_id int, name string, email string", ("U1", 1, "a", "b"))
    subs = frame("sub_id long, user_legacy_id string, start_date date, end_date date, plan_type_id int, last_event_type_id int",
                 (1, "U1", None, None, 1, 1))
    viewing = frame("session_id long, user_legacy_id string, content_id long, device_id long, session_start_ts timestamp_ntz, "
                    "duration_watched_sec int, rating int", (1, "U1", 2, 3, None, 4, 5), (2, None, 2, 9, None, 4, 5))
    payments = frame("payment_id long, user_legacy_id string, sub_id long, amount decimal(10,2)", (1, "U1", 1, None), (2, "U1", None, None))
    days = gold.dim_date(spark)
    content = frame("content_key string", ("2",))
    dim = frame("user_key string", ("U1",))
    types = frame("event_type_id int, event_type_name string", (1, "x"))

    def run():
        checked = silver.check_fks("viewing_activity", viewing, {
            "users": users, "watchlist": frame("content_id long", (2,)), "devices": frame("device_id long", (3,))})
        assert (parents(checked, "BroadcastHashJoin"), parents(checked, "SortMergeJoin")) == (0, 3)
        assert {tuple(r)[-3:] for r in checked.collect()} == {(True, True, True), (None, True, None)}
        paid = silver.check_fks("payments", payments, {"subscriptions": subs})
        assert parents(paid, "BroadcastHashJoin") == 0 and {r["__in_subscriptions"] for r in paid.collect()} == {True, None}
        seen = gold.star_viewing_activity(viewing, dim, content, days)          # the calendar is bounded
        assert (parents(seen, "BroadcastHashJoin"), parents(seen, "SortMergeJoin")) == (1, 2)
        facts = gold.star_subscription_events(payments, subs, dim, days, types)  # and so are the event types
        assert (parents(facts, "BroadcastHashJoin"), parents(facts, "SortMergeJoin")) == (2, 2)
        assert facts.count() == 2
        located = frame("country_id int, country_name string, region_name string", (1, "x", "y"))
        who = gold.dim_user(users, located, subs, frame("plan_type_id int, plan_type_name string", (1, "p")))
        assert parents(who, "SortMergeJoin") == 1 and who.count() == 1

    with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "64m"}, run)


def test_raw_payments_meet_their_orders_in_a_shuffle(spark, tmp_path):
    import datetime as dt

    from lakestar.sources.fixtures import Fixtures

    day = dt.datetime(1996, 1, 2)
    spark.createDataFrame([(1, 5)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 1, 2.0, 10.0, "N", "O", day), (9, 1, 2.0, 10.0, "N", "O", day)],
                          "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    paid = Fixtures(spark, str(tmp_path)).payments
    assert "BroadcastHashJoin" not in paid._jdf.queryExecution().sparkPlan().toString()
    assert [r.payment_id for r in paid.collect()] == [11]


def test_published_gold_writes_no_checked_raw_tables(spark, tmp_path):
    from lakestar.sources import sinks

    df = spark.range(3)
    w = sinks.LayerWriter(spark, str(tmp_path), checked=False)
    assert w("bronze", "users_fk_checked", df) is df and not w.stats
    assert w("silver", "users", df).count() == 3 and [s.table for s in w.stats] == ["users"]
    assert sinks.LayerWriter(spark, str(tmp_path))("bronze", "users_fk_checked", df).inputFiles()
