"""Hard negatives by slot-decomposed selection.

Vectors become integers, so scores (inner products) are exact. Every row whose id is divisible by ``EVERY``
is an anchor; its positives are the first rows of its own label by score. Each positive asks for the first
different-label rows with a score between 80% and 100% of its own: overlapping windows. Their upper limits
split an anchor's scores into disjoint slots, (next lower limit, this limit]; every block of rows keeps the
first ``TOP`` of each slot, blocks are combined per slot, and merging the slots from the lowest upwards
gives the first ``TOP`` at or under every limit. The lower limit then only cuts a merged list's tail.

The anchors are the stated query set: blocks of anchors meet blocks of rows, one task a pair of blocks, twice
(positives, then negatives). A task holds one block of each and scores them part by part.

Rows with a null label or vector, or a null, NaN or infinite component, take no part, nor do rows whose squared length
does not fit a long. Vectors of different lengths are compared as if the shorter one ended in zeros. Null ids
are no anchors, keep their label and come last among equals. A repeated row is a row of its own: it is a positive
or a negative once more, and an anchor that repeats is answered as often.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.scratch import Scratch

EVERY = 100
TOP = 5
LOW, HIGH = 80, 100  # percent of the positive's score
SCALE = 256
PER_ROWS = 1 << 16     # rows of a block
PER_ANCHORS = 1 << 13  # anchors of a block
CELLS = 1 << 22        # scores that a task holds at a time
EXACT = 2.0**53        # up to here a product of doubles is exact


def prepared(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, id, label, q): the rows that take part, with shifted labels and integer components."""
    x = F.col("v")
    whole = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    size = F.aggregate(x, F.lit(0.0), lambda s, c: s + F.pow(F.floor(F.abs(c) * SCALE).cast("double") + 1, F.lit(2.0)))
    fits = F.forall(x, lambda c: F.abs(c) < 2.0**31) & (size < 2.0**62)
    label = F.col(label_col).cast("bigint")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), label.alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v")).where("label is not null and v is not null")
    return (rows.where(F.when(finite, fits).otherwise(False))
            .select(F.monotonically_increasing_id().alias("row"), "id",
                    F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
                    whole.cast("array<bigint>").alias("q")))


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    q = table["q"].combine_chunks()
    n = q.value_lengths().to_numpy()
    out = np.zeros((len(q), width), np.int64)
    out[np.arange(width) < n[:, None]] = q.flatten().to_numpy()
    return out


def _width(*tables: pa.Table) -> int:
    return max([1, *(int(t["q"].combine_chunks().value_lengths().to_numpy().max()) for t in tables)])


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where no product can leave their exact range, else in longs."""
    bound = np.sqrt((anchors.astype(float)**2).sum(1).max()) * np.sqrt((rows.astype(float)**2).sum(1).max())
    if bound < EXACT / 4:
        return (anchors.astype(float) @ rows.astype(float).T).astype(np.int64)
    return anchors @ rows.T


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers, and whether each is missing (those come last among equals)."""
    ids = table["id"].combine_chunks()
    return ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)


def first_per_slot(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, ident: np.ndarray, missing: np.ndarray,
                   top: int = TOP) -> np.ndarray:
    """Which entries are among the first ``top`` of their (anchor, slot): higher scores, then smaller ids."""
    order = np.lexsort((ident, missing, -score, slot, anchor))
    a, s = anchor[order], slot[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])] if len(order) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - begin < top]


def _cells(scratch: Scratch, anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, pick, schema: str) -> DataFrame:
    """pick(anchors, rows) for every pair of a block of anchors and a block of rows."""
    blocks, parts = max(1, -(-n_anchors // PER_ANCHORS)), max(1, -(-n_rows // PER_ROWS))
    block, part = F.pmod(F.xxhash64("row"), F.lit(blocks)), F.pmod(F.xxhash64("row"), F.lit(parts))
    left = anchors.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = rows.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    empty = pa.schema([("anchor", pa.int64()), ("slot", pa.int64()), ("score", pa.int64()), ("id", pa.int64()),
                       ("missing", pa.bool_())]).empty_table()

    def run(a: pa.Table, r: pa.Table) -> pa.Table:
        if not a.num_rows or not r.num_rows:
            return empty
        width = _width(a, r)
        held = _matrix(a, width)
        step = max(1, CELLS // len(held))
        found = []
        for at in range(0, r.num_rows, step):
            own = r.slice(at, step)
            ident, missing = _ids(own)
            k, slot, j, score = pick(a, own, _scores(held, _matrix(own, width)))
            best = first_per_slot(k, slot, score, ident[j], missing[j])
            found.append((k[best], slot[best], score[best], ident[j][best], missing[j][best]))
        k, slot, score, ident, missing = (np.concatenate(x) for x in zip(*found, strict=True))
        best = first_per_slot(k, slot, score, ident, missing)
        row = a["row"].to_numpy()
        return pa.table([row[k[best]], slot[best], score[best], ident[best], missing[best]], schema=empty.schema)

    cells = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
        run, "anchor bigint, slot bigint, score bigint, id bigint, missing boolean")
    first = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "missing", "id")
    return scratch.keep(
        scratch.keep(cells, "cells").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= TOP)
        .select("anchor", "slot", "rank", "score", F.when(~F.col("missing"), F.col("id")).alias("id")), schema)


def _positives(a: pa.Table, r: pa.Table, scores: np.ndarray):
    k, j = np.nonzero((a["label"].to_numpy()[:, None] == r["label"].to_numpy()) & (a["row"].to_numpy()[:, None] != r["row"].to_numpy()))
    return k, np.zeros(len(k), np.int64), j, scores[k, j]


def _negatives(a: pa.Table, r: pa.Table, scores: np.ndarray):
    """Entries within some window, each in the slot of the lowest limit at or above it (slot 0: the highest limit)."""
    limits = a["limits"].to_pylist()  # falling, at most TOP of them
    top = np.array([x[0] for x in limits])
    least = np.array([-(-LOW * max(0, x[-1]) // HIGH) for x in limits])
    k, j = np.nonzero((scores <= top[:, None]) & (scores >= least[:, None]) & (a["label"].to_numpy()[:, None] != r["label"].to_numpy()))
    score = scores[k, j]
    table = np.array([x + [np.iinfo(np.int64).min] * (TOP - len(x)) for x in limits])
    return k, (table[k] >= score[:, None]).sum(1) - 1, j, score


def mined(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    scratch = Scratch(vectors.sparkSession, "negatives")
    rows = scratch.keep(prepared(vectors, id_col, vector_col, label_col), "rows")
    anchors = rows.where(F.col("id") % EVERY == 0)
    n_anchors, n_rows = anchors.count(), rows.count()
    found = _cells(scratch, anchors, rows, n_anchors, n_rows, _positives, "positives").drop("slot")
    # falling upper limits of each anchor; a negative limit's window is empty, as 80% of it lies above it
    limits = found.where("score >= 0").groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    asking = scratch.keep(anchors.join(limits, "row"), "asking")
    slots = _cells(scratch, asking, rows, n_anchors, n_rows, _negatives, "slots")
    # at most TOP slots of TOP entries an anchor, the lowest slot first
    held = F.sort_array(F.collect_list(F.struct((-F.col("slot")).alias("up"), "rank", "score", "id")))
    merged = slots.groupBy("anchor").agg(held.alias("entries")).select(
        "anchor", F.explode(F.sequence(F.lit(0), F.lit(TOP - 1))).alias("slot"), "entries")
    merged = merged.select("anchor", F.col("slot").cast("bigint").alias("slot"), _suffix(F.col("entries"), F.col("slot")).alias("first"))
    window = (found.join(asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "limits"), "anchor")
              .withColumn("slot", (F.array_position("limits", F.col("score")) - 1).cast("bigint")).where("slot >= 0")
              .select("anchor", "anchor_id", F.col("rank").alias("nth"), F.col("id").alias("positive_id"),
                      F.col("score").alias("positive_score"), "slot"))
    kept = F.filter("first", lambda x: x["score"] * HIGH >= F.col("positive_score") * LOW)
    return (window.join(merged, ["anchor", "slot"])
            .select("anchor_id", "positive_id", "positive_score", F.posexplode(kept).alias("at", "x"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("negative_id"),
                    "positive_score", F.col("x.score").alias("negative_score")))


def _suffix(entries, slot):
    """The first TOP entries of ``slot`` and the slots under it: each slot's list, from the lowest up, goes before what is merged."""
    empty = F.array().cast("array<struct<up:bigint,rank:int,score:bigint,id:bigint>>")

    def step(done, k):
        own = F.filter(entries, lambda x: x["up"] == -(F.lit(TOP - 1) - k).cast("bigint"))
        return F.when(F.lit(TOP - 1) - k >= slot, F.slice(F.concat(own, done), 1, TOP)).otherwise(done)

    return F.aggregate(F.sequence(F.lit(0), F.lit(TOP - 1)), empty, step)


def op12_slot_negatives(spark, sf_dir: str) -> DataFrame:
    return mined(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
