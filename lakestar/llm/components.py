"""Connected components and sub-quadratic linking of groups (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.scratch import Scratch


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is the smallest node reachable.

    Alternating large-star and small-star steps. Each step is a partial aggregate and two
    joins on the node, which AQE may split; it ends when every node but the centres has one edge, to a centre.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = scratch.keep(small, "stars")
        centres = e.select(F.col("v").alias("u")).distinct().withColumn("centre", F.lit(True))
        loose = e.groupBy("u").agg(F.count("*").alias("n")).join(centres, "u", "left").where("n > 1 or centre")
        if loose.isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def link_groups(scratch: Scratch, entries: DataFrame, verify: Callable[[DataFrame], DataFrame],
                may: Callable[[str, str], str] = lambda a, b: "true", rounds: int = 2,
                worth: str = "0") -> DataFrame:
    """Components (node, component) of the nodes of ``entries`` (key, node, ...) that verified pairs link.

    Two nodes are a candidate pair if they share a key. ``verify`` takes distinct pairs (a, b) and
    returns those that hold; ``may(a, b)`` is a cheap SQL condition over two aliased entry rows, true for at
    least one shared key of any pair that holds. ``worth`` is an SQL expression over an entry, high for nodes
    that are likely to be linked to many others; it guides the choice of pivots and changes no result.
    Pairs inside one component need no check, as they cannot change the result, so the pairs of a key are
    not enumerated:

    * in each round every key that still spans several components picks one pivot (the worthiest node, in
      later rounds the worthiest outside that one's component), and its members of other components are
      checked against it alone: linear in the entries;
    * what is left after the rounds, members of different components under one key, is
      checked pair by pair, so no link is lost.
    """
    spark = scratch.spark
    links = tried = None
    comp = None
    for r in range(rounds + 1):
        e = entries.withColumn("comp", F.col("node"))
        if comp is not None:
            e = (entries.join(comp, "node", "left")
                 .withColumn("comp", F.coalesce("component", "node")).drop("component"))
        best = F.max(F.struct(F.expr(worth).alias("worth"), F.xxhash64("node", F.lit(r)).alias("h"), "node", "comp"))
        spans = e.groupBy("key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), best.alias("p")).where("lo <> hi")
        e = e.join(spans.select("key", F.col("p.node").alias("pivot"), F.col("p.comp").alias("pivot_comp")), "key")
        e = scratch.keep(e, "spanning")
        if 0 < r < rounds:
            others = e.where("comp <> pivot_comp").groupBy("key").agg(best.alias("p"))
            e = e.drop("pivot").join(others.select("key", F.col("p.node").alias("pivot")), "key")
        if e.isEmpty():
            break
        x, y = e.alias("x"), e.alias("y")
        if r < rounds:
            pairs = x.join(e.where("node = pivot").alias("y"), "key")
        else:
            pairs = x.join(y, F.expr("x.key = y.key and x.comp < y.comp"))
        pairs = (pairs.where(f"x.comp <> y.comp and ({may('x', 'y')})")
                 .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = scratch.keep(pairs, "pairs")
        held = scratch.keep(verify(pairs), "links")
        links = held if links is None else links.unionByName(held)
        tried = pairs if tried is None else tried.unionByName(pairs)
        comp = scratch.keep(components(scratch, links), "components")
    if comp is None:
        comp = spark.createDataFrame([], "node bigint, component bigint")
    return comp
