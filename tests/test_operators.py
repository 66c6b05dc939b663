"""Dedupe, dense ids, size-checked joins, fingerprint, quality checks."""

from pyspark.sql import functions as F

from lakestar.operators import audit, quality
from lakestar.operators.dedupe import asc, desc, first_per_key
from lakestar.operators.keys import dense_ids


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_total_order_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, 5, "b"), (1, 5, "a"), (2, 3, "z"), (2, None, "y")], "k int, v int, s string")
    got = {r.k: (r.v, r.s) for r in first_per_key(df, ["k"], [asc("v")]).collect()}
    assert got == {1: (5, "a"), 2: (3, "z")}            # NULLS LAST, ties broken by the rest
    got = {r.k: (r.v, r.s) for r in first_per_key(df, ["k"], [desc("v", nulls_first=True)]).collect()}
    assert got == {1: (None, "a"), 2: (None, "y")}


def test_first_per_key_hot_key_is_partially_aggregated(spark):
    hot = spark.range(0, 20000).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    cold = spark.range(0, 100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    out = first_per_key(hot.unionByName(cold), ["k"], [desc("v")])
    got = {r.k: r.v for r in out.collect()}
    assert got[7] == 19999 and len(got) == 100
    p = plan(out)
    assert "WindowGroupLimit" in p and "Partial" in p  # map-side top-1 before the shuffle
    both = first_per_key(hot.unionByName(cold), ["k"], [desc("v")], extra_aggs=[F.min("v").alias("lo")])
    assert {r.k: (r.v, r.lo) for r in both.collect()}[7] == (19999, 0)
    assert "partial_min" in plan(both)


def test_dense_ids_range_path(spark):
    names = spark.createDataFrame([(f"n{i:03d}",) for i in range(57)], "name string").repartition(5)
    ids = dense_ids(names, "name", "id")
    rows = sorted((r.id, r.name) for r in ids.collect())
    assert rows == [(i + 1, f"n{i:03d}") for i in range(57)]


def test_dense_ids_number_each_group_from_one(spark):
    rows = [(g, f"{g}{i:03d}") for g in "abc" for i in range(31)]
    ids = dense_ids(spark.createDataFrame(rows, "g string, name string").repartition(7), "name", "id", group_col="g")
    assert sorted((r.g, r.id, r.name) for r in ids.collect()) == sorted(
        (g, i + 1, f"{g}{i:03d}") for g in "abc" for i in range(31))


def test_fingerprint_is_order_free_and_null_aware(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (None, "z")], "a int, b string")
    b = spark.createDataFrame([(None, "z"), (2, None), (1, "x")], "a int, b string").repartition(3)
    assert audit.fingerprint(a).first() == audit.fingerprint(b).first()
    from pyspark.sql import Observation
    obs = Observation("fp")
    a.observe(obs, *audit.fingerprint_metrics(a)).write.format("noop").mode("overwrite").save()
    assert audit.fingerprint_from_metrics(obs.get) == audit.fingerprint(a).first().fingerprint
    c = spark.createDataFrame([(None, 1)], "a int, b int")
    d = spark.createDataFrame([(1, None)], "a int, b int")
    assert audit.fingerprint(c).first().fingerprint != audit.fingerprint(d).first().fingerprint


def test_key_summary_counts_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    r = quality.key_summary(df, "t", ["k"]).first()
    assert (r.total_rows, r.null_key_rows, r.duplicate_key_values) == (5, 2, 1)


def test_orphans_and_varchar(spark):
    child = spark.createDataFrame([(1, "abc"), (2, "abcdef"), (None, None)], "p int, s string")
    parent = spark.createDataFrame([(1,)], "id int")
    assert quality.orphan_summary(child, "p", parent, "id", "c", "p").first().orphan_rows == 1
    nn, vc = quality.column_checks(child, "c", ["p"], {"s": 3})
    r = vc.first()
    assert (r.column_name, r.max_chars, r.overflow_rows) == ("s", 3, 1)
    assert nn.first().null_rows == 1


def test_lookups_do_not_depend_on_join_strategy(spark):
    """The same ids and maps whether Catalyst broadcasts the small sides or shuffles them."""
    from lakestar.plans import silver
    from lakestar.sources.fixtures import Fixtures
    from tests.conftest import SMALL_SF
    from tests.test_scale import with_conf
    raw = Fixtures(spark, SMALL_SF).raw()

    def run():
        found = silver.all_lookups(raw)
        w = silver.watchlist(raw["watchlist"], found.value_maps["dim_content_types"], found.value_maps["dim_genres"])
        return {n: (sorted(found.tables[n].collect()), sorted(found.value_maps[n].collect()))
                for n in silver.LOOKUP_SPECS} | {"watchlist": sorted(w.collect())}

    assert with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, run) == run()
