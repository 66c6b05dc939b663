"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

1. Each row is reduced to the SHA-256 of its normalised text (A-Z lower-cased).
2. Misra-Gries: the digests of each run of rows are folded into at most
   ``COUNTERS`` counters; summed over runs, a digest that holds more than
   2 / (COUNTERS + 1) of all rows is always among the counters' best, and at most
   ``COUNTERS + 1`` digests reach the threshold, whatever the input. That is the
   bound of what is broadcast.
3. The candidates are verified by an exact map-side count. Their rows are settled by a
   broadcast join and never shuffled.
4. All other digests, none of which is frequent, go through an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.scratch import Scratch

COUNTERS = 255
RUN_BITS = 12  # rows of one Misra-Gries fold: 2**RUN_BITS

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, UPPER.lower())


def misra_gries(keys: Column, counters: int = COUNTERS) -> Column:
    """Fold an array of keys into at most ``counters`` (key, n) pairs, n never above the true count."""
    empty = F.array().cast("array<struct<key:bigint,n:bigint>>")

    def step(held: Column, key: Column) -> Column:
        return (
            F.when(F.exists(held, lambda x: x["key"] == key),
                   F.transform(held, lambda x: F.struct(
                       x["key"].alias("key"), (x["n"] + (x["key"] == key).cast("bigint")).alias("n"))))
            .when(F.size(held) < counters,
                  F.concat(held, F.array(F.struct(key.alias("key"), F.lit(1).cast("bigint").alias("n")))))
            .otherwise(F.filter(
                F.transform(held, lambda x: F.struct(x["key"].alias("key"), (x["n"] - 1).alias("n"))),
                lambda x: x["n"] > 0)))

    return F.aggregate(keys, empty, step)


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Candidate heavy hitters of column ``key``: at most counters + 1 rows."""
    runs = (digests.select("key", F.shiftright(F.monotonically_increasing_id(), RUN_BITS).alias("run"))
            .groupBy("run").agg(F.collect_list("key").alias("keys"), F.count("*").alias("rows")))
    folded = runs.select("rows", misra_gries(F.col("keys"), counters).alias("held"))
    total = folded.agg(F.sum("rows").alias("total"))
    return (folded.select(F.explode("held").alias("x")).groupBy(F.col("x.key").alias("key"))
            .agg(F.sum("x.n").alias("n")).join(F.broadcast(total))
            .where(F.col("n") * (counters + 1) >= F.col("total")).select("key"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           counters: int = COUNTERS) -> DataFrame:
    """One row per input row: the id, keep_id, group_size, kept, text_sha256, n_same.

    Of rows with equal normalised text the one with the largest id stays (null ids come last;
    of rows that repeat the same id one stays). ``n_same`` counts the rows of the group that
    carry the winner's id, for a caller that goes back to the rows. A null text is empty.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    digests = scratch.keep(
        docs.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("sha"))
        .select("id", F.unhex("sha").alias("digest"), F.monotonically_increasing_id().alias("row"))
        .withColumn("key", F.xxhash64("digest")), "digests")
    candidates = F.broadcast(scratch.keep(frequent(digests, counters), "candidates"))

    # exact counts and winners, combined map-side; no window holds a group
    def winners(rows: DataFrame) -> DataFrame:
        return (rows.groupBy("key", "digest", "id").agg(F.count("*").alias("rows"), F.max("row").alias("row"))
                .groupBy("key", "digest").agg(
                    F.sum("rows").alias("group_size"),
                    F.max(F.struct("id", "row", F.col("rows").alias("n_same"))).alias("win")))

    def told(rows: DataFrame, winners: DataFrame) -> DataFrame:
        return rows.join(winners, ["key", "digest"]).select("id", "row", "digest", "group_size", "win")

    # a candidate is one xxhash64 value; its digests (one, but for a collision) all stay in the table
    heavy = told(digests, F.broadcast(scratch.keep(winners(digests.join(candidates, "key")), "winners")))
    rest = digests.join(candidates, "key", "left_anti")
    light = told(rest, winners(rest))
    return heavy.unionByName(light).select(
        F.col("id").alias(id_col), F.col("win.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("win.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), F.col("win.n_same").alias("n_same"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Rows that repeat both id and text are told apart by a window over those few rows only.
    """
    names = docs.columns
    wins = decide(docs, id_col, text_col).where("kept").select(
        F.col("keep_id").alias("__win_id"), F.col("text_sha256").alias("__win_sha"), F.col("n_same").alias("__win_same"))
    rows = docs.withColumn("__row_sha", F.sha2(normalised(F.col(text_col)), 256))
    found = rows.join(wins, F.col(id_col).eqNullSafe(F.col("__win_id")) & (F.col("__row_sha") == F.col("__win_sha")))
    once = found.where("__win_same = 1").select(*names)
    first = Window.partitionBy("__win_id", "__win_sha").orderBy(*[F.col(c) for c in names])
    repeated = (found.where("__win_same > 1").withColumn("__row_n", F.row_number().over(first))
                .where("__row_n = 1").select(*names))
    return once.unionByName(repeated)


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return decide(docs).drop("n_same")


OP7_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
