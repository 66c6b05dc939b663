"""LM scoring by a hierarchical Pitman-Yor model of word pairs, seated by Gibbs sampling.

Every context word has a restaurant whose customers are the words that follow it in training; all of them
share one parent restaurant of words, whose base is uniform over the known words and one unknown.
A new table in a context's restaurant is a customer of the parent.

Spark deals contexts to buckets; a bucket holds whole restaurants, so seating is local to it. The
restaurants of frequent contexts (at most 8 per bucket, found by a first pass) are spread over buckets word by word and their totals
are added up between passes. The texts are read once, in slices; a slice sends its distinct pairs to their buckets and keeps
postings (which document holds which of them) for the end. The schedule, each step a shuffle of packed blocks:

1. contexts, with the parent's probabilities estimated from the bucket's own words: seating and ``SWEEPS`` Gibbs
   sweeps; each word's tables and counts go to the word's bucket;
2. parent: the same sampler over the tables that came up; its averaged predictive probabilities go back;
3. contexts again with those probabilities: seating, ``SWEEPS`` sweeps of burn-in, then ``SAMPLES`` seatings, whose
   predictive probabilities are averaged. Every slice gets one log probability for each of its distinct pairs and
   adds them up by document, so what is sent grows with the text, not with documents times buckets.

A sweep takes every customer out in turn and seats it again by the Chinese-restaurant weights; customers of different
words move side by side, on the totals before their step. A word with more than ``LARGE`` customers in one restaurant has its number
of tables drawn instead, from its conditional given the restaurant's other tables (``large_tables``), so a bucket's work has a bound.
Words are 48-bit hashes: V words share one with a chance of V*V / 2**49.

A null text is empty and has its end token only. A null id counts as training. Rows that repeat both id
and text score alike and all of them train.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm import words as W
from lakestar.llm.scratch import Scratch

PER_BUCKET = 16 << 20  # bytes of text of a bucket
SENT = 16 << 20        # bytes of text whose pairs are combined before they are sent
MIN_BUCKETS = 16       # of the smallest inputs; buckets follow the text alone, so scores do not change with the cluster
LARGE = 128            # customers of a word in one restaurant that are seated one by one
SWEEPS = 2
SAMPLES = 3
GRAIN = 1 << 16        # log probabilities of pairs travel as whole parts of this size
CONTEXT = (0.8, 1.0)   # discount and strength of context restaurants
PARENT = (0.7, 10.0)
FOLDS = 10
END = np.uint64(1)     # also the context of a text's first word
_DROP = np.uint64(16)


def large_tables(count: np.ndarray, rest: np.ndarray, parent: np.ndarray, tables: np.ndarray, discount: float,
                 strength: float) -> tuple[np.ndarray, np.ndarray]:
    """(mean, variance) of the tables that many customers of a word take, given the ``rest`` of the restaurant's tables.

    With a = (strength + discount * all tables) * parent, t tables of c customers weigh a**t times the number of ways to sit,
    whose generating function is exp(a * (1 - y**discount) / discount) in x = 1 - y. One table holds most customers; the saddle
    point a * x * y**(discount - 1) = c gives mean and variance of the others. As all tables include the word's own, the mean is a
    fixed point.
    """
    c, d = count.astype(float), discount
    others = tables - 1.0
    for _ in range(60):
        a = np.maximum((strength + d * (rest + 1 + others)) * parent, 1e-300)
        lo, hi = np.full(len(c), -700.0), np.full(len(c), -1e-12)
        for _ in range(50):  # x * y**(d - 1) falls in log y
            mid = (lo + hi) / 2
            high = np.log(a) + np.log(-np.expm1(mid)) - (1 - d) * mid > np.log(c)
            lo, hi = np.where(high, mid, lo), np.where(high, hi, mid)
        y = np.exp((lo + hi) / 2)
        new = np.clip(a * (1 - y ** d) / d, 0, c - 1)
        done = np.all(np.abs(new - others) <= 1e-4 * (1 + new))
        others = new
        if done:
            break
    spread = np.maximum(others - c / (1 + (1 - d) * (1 - y) / y), 1e-9)
    tight = 1 / spread - d / (strength + d * (rest + 1 + others))
    return 1 + others, np.where(tight > 0, 1 / np.maximum(tight, 1e-9), spread)


class Seating:
    """Customers of many (restaurant, dish) pairs, seated one by one; the pairs' steps are made side by side.

    ``scale``: of a restaurant's own tables to all it has; ``known``: all its tables where they are known, else nan.
    """

    def __init__(self, count: np.ndarray, room: np.ndarray, n_rooms: int, parent: np.ndarray, discount: float,
                 strength: float, seed: int, scale: float = 1.0, known: np.ndarray | None = None):
        self.rng = np.random.default_rng(seed)
        self.count, self.room, self.parent = count, room, parent
        self.d, self.s = discount, strength
        self.n_rooms, self.scale, self.known = n_rooms, scale, known
        self.tables = (count > 0).astype(np.int64)
        some = np.flatnonzero((count > 1) & (count <= LARGE))
        self.busy = some[np.argsort(-count[some], kind="stable")]  # those with a k-th customer stand first
        self.big = np.flatnonzero(count > LARGE)
        c = count[self.busy]
        self.first = np.cumsum(c) - c
        self.table = np.zeros(int(c.sum()), np.int32)  # of each customer, numbered within its dish
        self.size = np.zeros(len(self.table), np.int32)
        self.free = (np.arange(len(self.table)) - np.repeat(self.first, c)).astype(np.int32)  # numbers; the used ones first
        self.tables[self.busy] = 0
        self.sweep(seated=False)

    def room_tables(self) -> np.ndarray:
        t = np.bincount(self.room, self.tables, self.n_rooms) * self.scale
        return t if self.known is None else np.where(np.isnan(self.known), t, self.known)

    def sweep(self, seated: bool = True) -> None:
        """Every customer leaves and sits down again; not ``seated``: all come in, one after another."""
        rng, rooms = self.rng, self.room_tables()
        grows = np.full(self.n_rooms, float(self.scale))
        if self.known is not None:
            grows[~np.isnan(self.known)] = 0
        c_all = self.count[self.busy]
        alive = np.searchsorted(-c_all, -np.arange(int(c_all[0]) if len(c_all) else 0), "left")
        room_all, parent_all = self.room[self.busy], self.parent[self.busy]
        t_all = self.tables[self.busy]
        for k, m in enumerate(alive.tolist()):
            first, room = self.first[:m], room_all[:m]
            t = t_all[:m].copy()
            if seated:
                left = self.table[first + k]
                self.size[first + left] -= 1
                empty = self.size[first + left] == 0
                t -= empty
                e = np.flatnonzero(empty)
                self.free[first[e] + t[e]] = left[e]
                n = c_all[:m] - 1
                total = rooms[room] - empty * grows[room]
            else:
                n = np.full(m, k)
                total = rooms[room]
            old = n - self.d * t
            fresh = rng.random(m) * (old + (self.s + self.d * total) * parent_all[:m]) >= old
            fresh |= n == 0
            f = np.flatnonzero(fresh)
            slot = self.free[first[f] + t[f]]
            self.table[first[f] + k] = slot
            self.size[first[f] + slot] = 1
            t[f] += 1
            j = np.flatnonzero(~fresh)
            while len(j):  # a table in proportion to its size less the discount, by rejection
                other = (rng.random(len(j)) * n[j]).astype(np.int64)
                if seated:
                    other += other >= k
                pick = self.table[first[j] + other]
                size = self.size[first[j] + pick]
                ok = rng.random(len(j)) * size < size - self.d
                g = j[ok]
                self.table[first[g] + k] = pick[ok]
                self.size[first[g] + pick[ok]] += 1
                j = j[~ok]
            moved = np.flatnonzero(t != t_all[:m])
            np.add.at(rooms, room[moved], (t[moved] - t_all[moved]) * grows[room[moved]])
            t_all[:m] = t
        self.tables[self.busy] = t_all
        if len(self.big):
            b = self.big
            own = self.tables[b] * grows[self.room[b]]
            mean, var = large_tables(self.count[b], np.maximum(rooms[self.room[b]] - own, 0), self.parent[b],
                                     self.tables[b], self.d, self.s)
            m = np.maximum(mean - 1, 1e-9)
            wide = np.maximum(var, m * (1 + 1e-6))  # the tables besides the first: negative binomial, normal where tighter
            drawn = np.where(var >= m, rng.negative_binomial(m * m / (wide - m), m / wide),
                             np.rint(m + np.sqrt(var) * rng.standard_normal(len(b))))
            self.tables[b] = 1 + np.clip(drawn, 0, self.count[b] - 1).astype(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table({str(i): pa.array([x.tobytes()], pa.binary()) for i, x in enumerate(arrays)})
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.compress(sink.getvalue().to_pybytes(), 1)


def _unpack(raw: bytes, *types: str) -> list[np.ndarray]:
    """Arrays of the given types; digits 4, 6 or 8 stand for ``_planes`` of so many bytes."""
    table = pa.ipc.open_stream(zstandard.decompress(raw)).read_all()
    out = []
    for column, kind in zip(table.columns, types, strict=True):
        data = column[0].as_py()
        if kind in "468":
            wide = np.zeros((len(data) // int(kind), 4 if kind == "4" else 8), np.uint8)
            wide[:, :int(kind)] = np.frombuffer(data, np.uint8).reshape(int(kind), -1).T
            out.append(wide.view(f"<u{wide.shape[1]}").ravel())
        else:
            out.append(np.frombuffer(data, kind))
    return out


def _planes(x: np.ndarray, k: int) -> np.ndarray:
    """The lowest k bytes of numbers, all first bytes before all second ones: small or ascending numbers pack well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].T)


def pairs(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, context, word) of every token, the end of each text included."""
    w = W.words(texts)
    n = w.counts() + 1
    stop = np.cumsum(n)
    word = np.full(int(stop[-1]) if len(n) else 0, END)
    inner = np.ones(len(word), bool)
    inner[stop - 1] = False
    word[inner] = w.hashes() >> _DROP
    context = np.full(len(word), END)
    context[1:] = word[:-1]  # the token before a text's first one is an end, too
    return np.repeat(np.arange(len(n)), n), context, word


def _spread(context: np.ndarray, word: np.ndarray, hot: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each pair: its context's, or for a frequent context one by the word."""
    at = np.minimum(np.searchsorted(hot, context), max(len(hot) - 1, 0))
    is_hot = hot[at] == context if len(hot) else np.zeros(len(context), bool)
    return (W.mix(np.where(is_hot, context * np.uint64(31) + word, context)) % np.uint64(n)).astype(np.int64)


def frequent(docs: DataFrame, n: int) -> np.ndarray:
    """Words of at least 1 / (8 n) of the tokens in some run of texts and in all of them: at most 8 n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in W.slices(b.column(0)):
                word, c = np.unique(pairs(texts)[2], return_counts=True)
                often = c * 8 * n >= c.sum()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[word[often], 0].astype(np.int64)), pa.array(np.r_[c[often], c.sum()])], ["word", "n"])

    seen = docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    total = seen.where("word = 0").select(F.col("n").alias("total"))
    often = seen.join(F.broadcast(total)).where(f"word <> 0 and n * {8 * n} >= total").select("word")
    return np.sort(np.array([r[0] for r in often.collect()], np.uint64))


def _pack_pairs(context: np.ndarray, word: np.ndarray, count: np.ndarray) -> bytes:
    """Pairs in order of their context, each context once."""
    new = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.zeros(0, np.int64)
    names, of = np.unique(word, return_inverse=True)
    return _pack(_planes(context[new], 6), _planes(np.diff(np.r_[new, len(context)]), 4), _planes(names, 6), _planes(of, 4),
                 _planes(count, 8))


def _unpack_pairs(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    context, run, names, of, count = _unpack(raw, "6", "4", "6", "4", "8")
    return np.repeat(context, run), names[of], count.astype(np.int64)


def sent_pairs(docs: DataFrame, hot: np.ndarray, n: int) -> DataFrame:
    """(bucket, slice, block): a slice's distinct pairs with their training counts by bucket, in order of (context, word).

    And one row with a negative bucket for each slice: its documents' keys and the documents of each of its pairs, in order of
    (bucket, context, word).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for first, texts in W.slices(b.column(0), SENT):
                yield from send(number, texts, b.column(1).slice(first, len(texts)), b.column(2).slice(first, len(texts)))
                number += 1
                W.give_back()

    def send(number: int, texts: pa.Array, train: pa.Array, keys: pa.Array) -> Iterator[pa.RecordBatch]:
        train, keys = train.to_numpy(zero_copy_only=False), keys.to_numpy()
        parts = [((of + first).astype(np.int32), c, w) for first, part in W.slices(texts) for of, c, w in [pairs(part)]]
        of, context, word = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        bucket = _spread(context, word, hot, n).astype(np.int32)
        order = np.lexsort((word, context, bucket))  # stable: documents stay in order
        of, context, word, bucket = (x[order] for x in (of, context, word, bucket))
        del order
        new = np.r_[True, (word[1:] != word[:-1]) | (context[1:] != context[:-1])]
        start = np.flatnonzero(new)
        post = np.flatnonzero(new | np.r_[True, of[1:] != of[:-1]])
        held = np.diff(np.r_[np.searchsorted(post, start), len(post)])
        raw = _pack(_planes(held, 4), _planes(of[post], 4), _planes(np.diff(np.r_[post, len(of)]), 4), keys)
        yield batch(-1 - number % n, number, raw)
        count = np.add.reduceat(train[of], start, dtype=np.int64)
        context, word, bucket = context[start], word[start], bucket[start]
        ends = np.flatnonzero(np.r_[bucket[1:] != bucket[:-1], True]) + 1
        for a, z in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            yield batch(int(bucket[a]), number, _pack_pairs(context[a:z], word[a:z], count[a:z]))

    def batch(bucket: int, number: int, raw: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([number], pa.int64()), pa.array([raw], pa.binary())],
            ["bucket", "slice", "block"])

    return docs.select("text", "train", "key").mapInArrow(run, "bucket int, slice bigint, block binary")


def _merged(context: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(context, word, count) distinct, ascending, and the place of each given pair among them."""
    order = np.lexsort((word, context))
    c, w = context[order], word[order]
    new = np.r_[True, (c[1:] != c[:-1]) | (w[1:] != w[:-1])] if len(c) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    place = np.empty(len(c), np.int64)
    place[order] = group
    return c[new], w[new], np.bincount(place, n, int(new.sum())).astype(np.int64), place


# kinds of rows that the first seating writes
WORDS, TOTALS, PLACES, PAIRS, POSTINGS = range(5)
SEATED = "kind int, bucket int, at bigint, block binary, n bigint, t bigint"


def _seated(rows: list[tuple]) -> pa.Table:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    names = ("kind", "bucket", "at", "block", "n", "t")
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table({f: pa.array(c, k) for f, c, k in zip(names, cols, types, strict=True)})


def model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS,
                 samples: int = SAMPLES, sweeps: int = SWEEPS, seed: int = 0) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "pitman-yor")
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("id", "text")).withColumn("held_out", held).withColumn("train", ~held)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(MIN_BUCKETS, -(-size // PER_BUCKET))
    hot = frequent(rows, n)
    (d, s), (d0, s0) = CONTEXT, PARENT

    def first_seating(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        slices = table["slice"].to_pylist()
        if bucket < 0:
            return _seated([(POSTINGS, bucket, k, x.as_py(), None, None) for k, x in zip(slices, table["block"], strict=True)])
        parts = [_unpack_pairs(x.as_py()) for x in table["block"]]
        context, word, count, place = _merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        out = [(PAIRS, bucket, None, _pack_pairs(context, word, count), None, None)]
        begin = 0
        for k, part in zip(slices, parts, strict=True):  # ascending places, so their steps are small
            mine = place[begin:begin + len(part[0])]
            begin += len(part[0])
            out.append((PLACES, bucket, k, _pack(_planes(np.diff(mine, prepend=0), 4)), None, None))
        del parts, place
        names, of = np.unique(word, return_inverse=True)
        share = np.bincount(of, count > 0)  # in how many contexts the bucket has the word
        rooms, room = np.unique(context, return_inverse=True)
        seats = Seating(count, room, len(rooms), (share / max(share.sum(), 1))[of], d, s, seed + bucket)
        for _ in range(sweeps):
            seats.sweep()
        up = np.bincount(of, seats.tables, len(names)).astype("<u8")
        c = np.bincount(of, count, len(names)).astype("<u8")
        to = (W.mix(names) % np.uint64(n)).astype(np.int64)
        for k in np.unique(to).tolist():
            mine = to == k
            out.append((WORDS, bucket, k, _pack(_planes(names[mine], 6), _planes(c[mine], 8), _planes(up[mine], 8)), None, None))
        in_room, t_room = np.bincount(room, count, len(rooms)), seats.room_tables()
        for i in np.flatnonzero(np.isin(rooms, hot)).tolist():
            out.append((TOTALS, bucket, int(rooms[i]), None, int(in_room[i]), int(t_room[i])))
        del seats, context, word, count, of, room
        W.give_back()
        return _seated(out)

    up = scratch.keep(sent_pairs(rows, hot, n).groupBy("bucket").applyInArrow(first_seating, SEATED), "seated", "kind")
    totals = {r["at"]: (r["n"], r["t"]) for r in up.where(F.col("kind") == TOTALS).groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("t").alias("t")).collect()}  # one row per frequent context

    def words_of(table: pa.Table) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        parts = [_unpack(x.as_py(), "6", "8", "8") for x in table["block"]]
        word, c, t = (np.concatenate(x) for x in zip(*parts, strict=True))
        names, of = np.unique(word, return_inverse=True)
        return parts, names, of, np.bincount(of, c), np.bincount(of, t)

    def summed(table: pa.Table) -> pa.Table:
        _, _, _, c, t = words_of(table)
        return pa.table({"tokens": [int(c.sum())], "words": [int((c > 0).sum())], "tables": [int(t.sum())]})

    asked = up.where(F.col("kind") == WORDS).select("at", "bucket", "block")
    told = asked.groupBy("at").applyInArrow(summed, "tokens bigint, words bigint, tables bigint").agg(
        F.sum("tokens").alias("tokens"), F.sum("words").alias("words"), F.sum("tables").alias("tables")).first()
    n_train, n_words, n_customers = (int(x or 0) for x in told)

    def parent_seating(table: pa.Table) -> pa.Table:
        """Counts and averaged parent probabilities of the words each bucket asked for, in its order."""
        parts, names, of, c, t = words_of(table)
        t = t.astype(np.int64)
        base = np.full(len(names), 1 / (n_words + 1))
        seats = Seating(t, np.zeros(len(t), np.int64), 1, base, d0, s0, seed + 10**6 + table["at"][0].as_py(),
                        n_words / max(int((t > 0).sum()), 1))
        p = np.zeros(len(names))
        for k in range(sweeps + samples):
            seats.sweep()
            if k >= sweeps:
                p += (t - d0 * seats.tables + (s0 + d0 * seats.room_tables()[0]) * base) / (s0 + n_customers)
        p /= samples
        out, begin = [], 0
        for part in parts:
            mine = of[begin:begin + len(part[0])]
            begin += len(part[0])
            out.append(_pack(_planes(c[mine], 8), p[mine].astype("<f4")))
        return pa.table({"at": table["at"], "bucket": table["bucket"], "words": pa.array(out, pa.binary())})

    down = scratch.keep(asked.groupBy("at").applyInArrow(
        parent_seating, "at bigint, bucket int, words binary"), "parents")
    floor = math.log10(n_train + 0.1 * (n_words + 1))

    def score(block: pa.Table, parents: pa.Table) -> pa.Table:
        """For each slice: log probabilities of its pairs in the bucket, and how often training has their words."""
        kinds = np.asarray(block["kind"])
        if not len(kinds):
            return pa.table({"slice": pa.array([], pa.int64()), "bucket": pa.array([], pa.int32()),
                             "block": pa.array([], pa.binary())})
        bucket = block["bucket"][0].as_py()
        context, word, count = _unpack_pairs(block["block"][int(np.flatnonzero(kinds == PAIRS)[0])].as_py())
        names, of = np.unique(word, return_inverse=True)
        to = W.mix(names) % np.uint64(n)
        counts, parent = np.zeros(len(names), np.uint64), np.zeros(len(names))
        for k, x in zip(parents["at"].to_pylist(), parents["words"], strict=True):  # in the order the bucket asked
            counts[to == k], parent[to == k] = _unpack(x.as_py(), "8", "<f4")
        counts, parent = counts[of], parent[of]

        seen = np.flatnonzero(count > 0)
        rooms, room = np.unique(context, return_inverse=True)
        customers = np.bincount(room, count, len(rooms))
        known = np.full(len(rooms), np.nan)
        for i in np.flatnonzero(np.isin(rooms, hot)).tolist():
            customers[i], known[i] = totals.get(int(rooms[i]), (0, 0))
        seats = Seating(count[seen], room[seen], len(rooms), parent[seen], d, s, seed + 2 * 10**6 + bucket, known=known)
        p = np.zeros(len(word))
        for k in range(sweeps + samples):
            seats.sweep()
            if k >= sweeps:
                left = np.zeros(len(word))
                left[seen] = count[seen] - d * seats.tables
                p += (left + (s + d * seats.room_tables()[room]) * parent) / (s + customers[room])
        log = np.rint(-np.log10(p / samples) * GRAIN).astype(np.int64)
        del seats, seen, p, left, context, word, count, of, room, parent
        W.give_back()
        out = {"slice": [], "bucket": [], "block": []}
        for i in np.flatnonzero(kinds == PLACES).tolist():
            place = np.cumsum(_unpack(block["block"][i].as_py(), "4")[0], dtype=np.int64)
            out["slice"].append(block["at"][i].as_py())
            out["bucket"].append(bucket)
            out["block"].append(_pack(_planes(log[place], 4), _planes(counts[place], 8)))
        return pa.table({"slice": pa.array(out["slice"], pa.int64()), "bucket": pa.array(out["bucket"], pa.int32()),
                         "block": pa.array(out["block"], pa.binary())})

    def by_document(logs: pa.Table, postings: pa.Table) -> pa.Table:
        """A slice's answers, in order of their bucket as its postings are, added up by document."""
        order = np.argsort(np.asarray(logs["bucket"])).tolist()
        parts = [_unpack(logs["block"][i].as_py(), "4", "8") for i in order]
        log, counts = (np.concatenate([x[i] for x in parts]).astype(float) for i in range(2))
        held, of, times, keys = _unpack(postings["block"][0].as_py(), "4", "4", "4", "<i8")
        del parts
        W.give_back()
        log, counts = np.repeat(log / -GRAIN, held), np.repeat(counts, held)
        m = len(keys)
        base = np.log10(counts + 0.1) - floor
        return pa.table({"key": keys, "n": np.bincount(of, times, m).astype(np.int64),
                         "known": np.bincount(of, times * (counts > 0), m).astype(np.int64),
                         "base": np.bincount(of, times * base, m), "log": np.bincount(of, times * log, m)})

    pairs_of = up.where(F.col("kind").isin(PLACES, PAIRS)).select("kind", "bucket", "at", "block")
    logs = pairs_of.groupBy("bucket").cogroup(down.groupBy("bucket")).applyInArrow(
        score, "slice bigint, bucket int, block binary")
    postings = up.where(F.col("kind") == POSTINGS).select(F.col("at").alias("slice"), "block")
    scored = logs.groupBy("slice").cogroup(postings.groupBy("slice")).applyInArrow(
        by_document, "key bigint, n bigint, known bigint, base double, log double")
    by_key = scored.groupBy("key").agg(*[F.sum(x).alias(x) for x in ("n", "known", "base", "log")])
    same = rows.groupBy("key").agg(F.count("*").alias("copies"))
    return (rows.select("id", "key", "held_out").join(by_key, "key").join(same, "key")
            .select(F.col("id").alias(id_col), "held_out",
                    F.expr("n div copies").alias("n_tokens"), F.expr("known div copies").alias("n_known"),
                    F.lit(n_train).cast("bigint").alias("train_tokens"), (F.col("base") / F.col("copies")).alias("base_score"),
                    (F.col("log") / F.col("copies")).alias("score")))


def op1_pitman_yor(spark, sf_dir: str) -> DataFrame:
    return model_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
