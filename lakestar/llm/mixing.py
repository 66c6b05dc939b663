"""Mixing sources to target weights by blocks.

* Each source's documents, in order of their id, form one stream of words, cut into blocks of
  ``BLOCK`` words. Stream places come from two-level prefix sums: rows are range-partitioned by (source, id, hash of
  the text), so a part is a run of the stream, and a hot source is spread over parts. Where the borders of
  the parts fall changes no place.
* Targets: all words are shared by weight; a source's target stops at ``REPEAT`` times its words
  and the excess is shared again by weight until none is above. If all stop, the rest is left.
* A source's slots run through its blocks pass after pass; each pass has its own pseudorandom
  permutation (a keyed Feistel network walked within the number of blocks). The last slot is cut, so
  the words of all slots are the target to the word; with at most ``REPEAT`` passes no
  document is taken more than ``REPEAT`` times.
* Each output shard draws its source counts from a multinomial of its own seed. Slots are dealt
  to shards in that order; a source that was drawn too often ends early, and one last shard per
  ``SHARD`` slots takes what was not drawn, so totals are exact and shards can be made apart.
* Slots and blocks are joined by (source, block).

The driver holds one row per source (the configured mixture). A null text has size 0 and is taken 0
times; a null source is a source of its own, weighed last; rows that repeat an id are ordered by a
hash of their text and taken on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm import words as W
from lakestar.llm.scratch import Scratch, buckets, reachable

BLOCK = 1024   # words
SHARD = 1024   # slots of an output shard
REPEAT = 3
WEIGHTS = (1, 2, 3)
PART = 20_000  # documents of one part of the streams, about
CHUNK = 4096   # shards whose draws are summed in one task


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, tie): one row per document."""
    reachable(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in W.slices(b.column(2)):
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, n), b.column(1).slice(first, n), pa.array(W.words(texts).counts()),
                     b.column(3).slice(first, n)], ["id", "source", "size", "tie"])

    return (docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                        F.col(text_col).cast("string").alias("text"))
            .withColumn("tie", F.xxhash64("text"))
            .mapInArrow(run, f"id {kind}, source string, size bigint, tie bigint"))


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS,
            repeat: int = REPEAT) -> dict[str | None, float]:
    """Words wanted of each source; sources in order of code points, null last."""
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    weigh = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    out: dict[str | None, float] = {}
    free, left = [s for s, _ in order], float(sum(size.values()))
    while free:
        per = left / sum(weigh[s] for s in free)
        full = [s for s in free if per * weigh[s] > repeat * size[s]]
        if not full:
            return out | {s: per * weigh[s] for s in free}
        for s in full:
            out[s] = float(repeat * size[s])
            left -= out[s]
        free = [s for s in free if s not in full]
    return out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed pseudorandom permutation of 0..n-1, at the places ``index``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 2**63, 4, dtype=np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> np.uint64(half), x & low
        for k in keys:
            a, b = b, a ^ (W.mix(b + k) & low)
        return (a << np.uint64(half)) | b

    out = once(index.astype(np.uint64))
    while (out_of := out >= n).any():
        out[out_of] = once(out[out_of])
    return out.astype(np.int64)


class Plan:
    """Per source: words, blocks, and the slots that make up its target."""

    def __init__(self, sizes: list[tuple[str | None, int]], weights=WEIGHTS, repeat=REPEAT, block=BLOCK, seed=0):
        self.block, self.seed = block, seed
        self.target = targets(sizes, weights, repeat)
        self.size = dict(sizes)
        self.sources = list(self.target)
        self.slots, self.cut = {}, {}
        for i, s in enumerate(self.sources):
            size = self.size[s]
            want = min(round(self.target[s]), repeat * size)
            n = -(-size // block)
            if not size or not want:
                self.slots[s] = self.cut[s] = 0
                continue
            passes, rest = divmod(want, size)
            slots, cut = passes * n, 0
            if rest:
                # the short last block may come early in the pass, and then one more slot is needed
                m = -(-rest // block)
                for m in (m, m + 1):
                    got = int(self._words(i, size, passes, np.arange(min(m, n))).sum())
                    if got >= rest:
                        break
                slots, cut = slots + min(m, n), got - rest
            self.slots[s], self.cut[s] = slots, cut

    def _words(self, i: int, size: int, turn: int, place: np.ndarray) -> np.ndarray:
        n = -(-size // self.block)
        return np.minimum(self.block, size - self.block * permuted(place, n, hash((self.seed, i, turn)) & (2**62 - 1)))

    def blocks_of(self, i: int, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, words left out at its end) of a source's slots."""
        s = self.sources[i]
        n = -(-self.size[s] // self.block)
        block = np.zeros(len(slot), np.int64)
        for turn in np.unique(slot // n):
            mine = slot // n == turn
            block[mine] = permuted(slot[mine] % n, n, hash((self.seed, i, int(turn))) & (2**62 - 1))
        return block, np.where(slot == self.slots[s] - 1, self.cut[s], 0)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, repeat: int = REPEAT, block: int = BLOCK, shard: int = SHARD,
          seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(documents, spans).

    documents: id, source, size, tie, source_size, target. spans: shard, slot, source_no, id, tie, start, words: which words of
    which document stand in which output shard, in order of (shard, source_no, slot, block place).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    found = scratch.keep(sized(docs, id_col, text_col, source_col), "sizes")
    told = found.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()
    plan = Plan([(r["source"], r["size"]) for r in told], weights, repeat, block, seed)
    number = spark.createDataFrame(
        [(s, i, plan.size[s], plan.target[s]) for i, s in enumerate(plan.sources)],
        "source string, source_no int, source_size bigint, target double")
    # equal rows may change places, so a row number can part them; written, as the borders are drawn from a sample
    rows = (found.join(F.broadcast(number), found["source"].eqNullSafe(number["source"]))
            .select(found["*"], "source_no", "source_size", "target", F.monotonically_increasing_id().alias("row"))
            .repartitionByRange(buckets(spark, sum(r["rows"] for r in told), PART), "source_no", "id", "tie", "row")
            .withColumn("part", F.spark_partition_id()))
    rows = scratch.keep(rows, "parts")
    sums = rows.groupBy("source_no", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("part_start"))
    ahead = (Window.partitionBy("source_no", "part").orderBy("id", "tie")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (rows.withColumn("stop", F.sum("size").over(ahead)).join(sums, ["source_no", "part"])
              .withColumn("begin", F.col("part_start") + F.col("stop") - F.col("size")))
    placed = scratch.keep(placed.select("id", "source", "size", "tie", "source_size", "target", "source_no", "begin"),
                          "places")
    held = (placed.where("size > 0")
            .withColumn("block", F.explode(F.sequence(
                F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block))))
            .withColumn("lo", F.greatest("begin", F.col("block") * block))
            .withColumn("hi", F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block))
            .select("source_no", "block", "id", "tie", "begin", "lo", "hi", "source_size"))
    full = F.least(F.col("source_size"), (F.col("block") + 1) * block) - F.col("left_out")
    spans = (slots(spark, scratch, plan, shard).join(held, ["source_no", "block"])
             .withColumn("words", F.least("hi", full) - F.col("lo")).where("words > 0")
             .select("shard", "slot", "source_no", "id", "tie", (F.col("lo") - F.col("begin")).alias("start"), "words"))
    return placed.select("id", "source", "size", "tie", "source_size", "target"), spans


def slots(spark, scratch: Scratch, plan: Plan, shard: int) -> DataFrame:
    """(shard, slot, source_no, block, left_out): every slot of the mix, made shard by shard."""
    k = len(plan.sources)
    wanted = np.array([plan.slots[s] for s in plan.sources], np.int64)
    total = int(wanted.sum())
    shards = -(-total // shard) if total else 0
    share = wanted / total if total else np.zeros(k)
    seed = plan.seed

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            n = np.stack([np.random.default_rng([seed, int(i)]).multinomial(shard, share) for i in ids]) \
                if len(ids) else np.zeros((0, k), int)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, k)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(ids))),
                 pa.array(n.ravel().astype(np.int64))], ["shard", "source_no", "n"])

    drawn = spark.range(shards).mapInArrow(draw, "shard bigint, source_no int, n bigint")
    drawn = scratch.keep(drawn, "draws")
    need = spark.createDataFrame([(i, int(n)) for i, n in enumerate(wanted)], "source_no int, wanted bigint")
    drawn_in = drawn.withColumn("chunk", F.expr(f"shard div {CHUNK}"))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = drawn_in.groupBy("source_no", "chunk").agg(F.sum("n").alias("chunk_n")).select(
        "source_no", "chunk", F.coalesce(F.sum("chunk_n").over(before), F.lit(0)).alias("chunk_at"))
    within = Window.partitionBy("source_no", "chunk").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    dealt = (drawn_in.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0)))
             .join(chunks, ["source_no", "chunk"]).withColumn("at", F.col("chunk_at") + F.col("within"))
             .join(F.broadcast(need), "source_no"))
    # what was not drawn: more shards of ``shard`` slots at the end
    rest = (need.join(drawn.groupBy("source_no").agg(F.sum("n").alias("n")), "source_no", "left")
            .withColumn("at", F.coalesce("n", F.lit(0))).where("at < wanted")
            .withColumn("more", F.explode(F.sequence(F.lit(0), F.floor((F.col("wanted") - F.col("at") - 1) / shard))))
            .select((F.lit(shards) + F.col("more")).alias("shard"), "source_no", F.lit(shard).cast("bigint").alias("n"),
                    (F.col("at") + F.col("more") * shard).alias("at"), "wanted"))
    dealt = (dealt.select("shard", "source_no", "n", "at", "wanted").unionByName(rest)
             .withColumn("n", F.least("n", F.col("wanted") - F.col("at"))).where("n > 0"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sh, no, n, at in zip(*(b.column(c).to_pylist() for c in ("shard", "source_no", "n", "at")), strict=True):
                slot = np.arange(at, at + n)
                block, left_out = plan.blocks_of(no, slot)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, sh)), pa.array(slot), pa.array(np.full(n, no, np.int32)), pa.array(block),
                     pa.array(left_out)], ["shard", "slot", "source_no", "block", "left_out"])

    return dealt.select("shard", "source_no", "n", "at").mapInArrow(
        fill, "shard bigint, slot bigint, source_no int, block bigint, left_out bigint")


def taken(docs: DataFrame, **options) -> DataFrame:
    """(id, source, size, tie, source_size, target, taken): one row per document."""
    found, spans = mixed(docs, **options)
    got = spans.groupBy("id", "tie").agg(F.sum("words").alias("got"))
    # rows that repeat both id and text share what was taken of them
    same = found.groupBy("id", "tie").agg(F.count("*").alias("rows"))
    per = got.join(same, got["id"].eqNullSafe(same["id"]) & got["tie"].eqNullSafe(same["tie"])).select(
        got["id"].alias("_id"), got["tie"].alias("_tie"), "got", "rows")
    nth = Window.partitionBy("id", "tie").orderBy("source", "size")
    return (found.withColumn("nth", F.row_number().over(nth))
            .join(per, F.col("id").eqNullSafe(F.col("_id")) & F.col("tie").eqNullSafe(F.col("_tie")), "left")
            .withColumn("taken", F.coalesce(
                F.expr("got div rows + if(nth <= got % rows, 1, 0)"), F.lit(0)).cast("bigint"))
            .select("id", "source", "size", "tie", "source_size", "target", "taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **options) -> DataFrame:
    """The mix as whole documents: each row as often as the mix takes its words, 0 to REPEAT times.

    A share of a document counts as one more copy with that chance, drawn from a hash of its id and text,
    so each source's words come near its target. Documents without words are not taken.
    """
    found, spans = mixed(docs, id_col, text_col, source_col, **options)
    words = found.where("size > 0").groupBy("id", "tie").agg(F.sum("size").alias("all_words"))
    got = spans.groupBy("id", "tie").agg(F.sum("words").alias("got"))
    got = got.join(words, got["id"].eqNullSafe(words["id"]) & (got["tie"] == words["tie"])).select(
        got["id"].alias("__mix_id"), got["tie"].alias("__mix_tie"), F.col("got").alias("__mix_got"),
        F.col("all_words").alias("__mix_words"))
    chance = F.pmod(F.xxhash64("__mix_id", "__mix_tie", F.lit("copies")), F.lit(1 << 20)) / F.lit(1 << 20)
    copies = got.select("__mix_id", "__mix_tie", F.floor(F.col("__mix_got") / F.col("__mix_words") + chance)
                        .cast("int").alias("__mix_copies")).where("__mix_copies > 0")
    rows = docs.withColumn("__row_tie", F.xxhash64(F.col(text_col).cast("string")))
    return (rows.join(copies, F.col(id_col).eqNullSafe(F.col("__mix_id")) & (F.col("__row_tie") == F.col("__mix_tie")))
            .withColumn("__mix_nth", F.explode(F.array_repeat(F.lit(1), F.col("__mix_copies"))))
            .select(*docs.columns))


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    return taken(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
