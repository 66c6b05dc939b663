"""Token ids in blocks of an adaptive context-mixing range coder.

A block holds whole documents, about ``BLOCK`` ids, and is coded from a reset state, so any block can be read on its own;
it carries the CRC-32 of its ids. A longer one, of one long document, is cut into parts of even length, ``BLOCK`` ids at
most, each coded from a reset state. An id is predicted by three orders:

* order 2: the id seen last after the two ids before it (hashed context), with a confidence of 0 to 3;
* order 1: the id seen last after the id before it, with a confidence;
* order 0: adaptive counts of the part's ids that were coded by them, taken up at steps that grow by half.

The mixer keeps, for every pair of confidences and whether both orders agree, the share of the coder's range that goes to
the order-2 and the order-1 prediction; the shares adapt after every id, and what is left goes to order 0. The parts of a
task are coded side by side, one id of each at a time, as numpy work; coder and decoder share the model code.

Format, a Parquet row per block: shard, block, doc_ids, lengths (ids of each document), crc32, data. data: for each part
the bytes of its ids' list and the number of its 16-bit code digits (both little-endian unsigned 32-bit), then for each
part the list, zstandard-compressed (distinct ids ascending as differences, 32 bits), and the digits (16 bits).

A null text is empty (its block has the end id alone); null ids come last; repeated ids are ordered by text hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.scratch import Scratch, buckets
from lakestar.llm.tokens import VOCABULARY, encoded, vocabulary

END = 2
BLOCK = 8192
LANES = 1024             # parts coded side by side
PER_SHARD = 16 << 20     # bytes of text of a shard
STEP = 24                # what an order-0 count grows by
CONTEXTS = 1 << 12       # hashed order-2 contexts of a part
LEAST, MOST = 15, (1 << 16) - 96  # of an adaptive share
_ONE = 1 << 16
_LOW32 = 2**32 - 1
_TARGET = np.array([LEAST, MOST])
_P, _Q, _CONTEXT = np.int32(40503), np.int32(30011), np.int32(CONTEXTS - 1)


class _Lanes:
    """The model and coder state of parts that are coded side by side, longest first.

    A slot of order 2 or 1 is one number, the id last seen times 4 plus its confidence. The shares of a predictor that is
    not to be used are 0 and stay so. All quantities are whole numbers, so coder and decoder come to the same intervals.
    """

    def __init__(self, lengths: np.ndarray, n_ids: np.ndarray):
        b = len(lengths)
        self.lengths = lengths
        self.n = np.maximum(n_ids, 1).astype(np.int64)
        self.v = int(self.n.max(initial=1))
        self.bits = np.ceil(np.log2(self.n)).astype(np.int64) + 2  # of the number of order-0 units, at least 4 an id
        self.units = np.int64(1) << self.bits
        lane = np.arange(b, dtype=np.int64)
        self.contexts, self.keys, self.ids = lane * CONTEXTS, lane * 32, lane * self.v
        self.slots = [np.zeros(b * CONTEXTS, np.int32), np.zeros(b * self.v, np.int32)]
        key = np.arange(32)  # confidence of order 2, of order 1, and whether they agree
        use2 = key >> 3 > 0
        use1 = (key >> 1 & 3 > 0) & ~(use2 & (key & 1 > 0))
        self.share = [np.tile(np.where(use2, _ONE // 2, 0), b), np.tile(np.where(use1, _ONE // 4, 0), b)]
        self.count = np.zeros(b * self.v, np.int32)
        self.place = np.zeros(b * self.v, np.int32)  # of an id in order 0: its first unit, and 2**16 times its units
        self.range = np.full(b, 2**48 - 1, np.int64)
        self.last = self.ids.copy()  # the first id counts as one after id 0
        self.before = np.zeros(b, np.int32)
        self.x = np.zeros(b, np.int32)

    def stretches(self) -> Iterator[tuple[int, int, int]]:
        """(first step, end, parts longer than the first step): order 0 takes up its counts before each."""
        t, steps = 0, int(self.lengths.max(initial=0))
        while t < steps:
            end = min(steps, t + min(max(16, t >> 1), 1024))
            yield t, end, int(np.searchsorted(-self.lengths, -t, "left"))
            t = end

    def renew(self, m: int, table: bool) -> np.ndarray | None:
        """Units for every id of the first m parts by the counts so far, and who holds each unit."""
        wide = int(self.units[:m].max())
        at = np.arange(1, self.v + 1)
        holds = np.zeros((m, wide + 1), np.uint16) if table else None
        for i in range(0, m, 128):
            own = slice(i, min(m, i + 128))
            n, units = self.n[own, None], self.units[own, None]
            cells = slice(i * self.v, own.stop * self.v)
            c = np.cumsum(self.count[cells].reshape(-1, self.v), axis=1, dtype=np.int64)
            c *= STEP
            c += at
            c *= (units - n << 32) // np.take_along_axis(c, n - 1, 1)
            c >>= 32
            c += at
            np.copyto(c, units, where=at >= n)
            if table:
                some = holds[own]
                some.reshape(-1)[c + np.arange(len(c))[:, None] * (wide + 1)] = 1
                np.cumsum(some, axis=1, dtype=np.uint16, out=some)
            # the first unit c[i - 1] and 2**16 times c[i] - c[i - 1]
            c[:, 1:] = (c[:, 1:] << 16) - c[:, :-1] * 0xFFFF
            c[:, 0] <<= 16
            self.place[cells] = c.ravel()
        return holds.ravel() if table else None

    def enter(self, m: int) -> None:
        """Take up the first m parts for a stretch of steps."""
        self.at_contexts, self.at_keys, self.at_ids, self.by = self.contexts[:m], self.keys[:m], self.ids[:m], self.bits[:m]
        self.at, self.z, self.a, self.ranges = self.last[:m], self.before[:m], self.x[:m], self.range[:m]

    def leave(self, m: int) -> None:
        self.last[:m], self.before[:m], self.x[:m] = self.at, self.z, self.a

    def predict(self) -> None:
        """The ids that orders 2 and 1 expect, and the parts of the range: ``two``, up to ``both``, a ``unit`` of the rest."""
        self.at2 = self.at_contexts + ((self.a * _P + self.z * _Q) & _CONTEXT)
        self.at1 = self.at
        self.w2, self.w1 = self.slots[0].take(self.at2, mode="clip"), self.slots[1].take(self.at1, mode="clip")
        self.c2, self.c1 = self.w2 >> 2, self.w1 >> 2
        self.k2, self.k1 = self.w2 & 3, self.w1 & 3
        self.key = self.at_keys + ((self.k2 << 3) + (self.k1 << 1) + (self.c2 == self.c1))
        self.p2, self.p1 = self.share[0].take(self.key, mode="clip"), self.share[1].take(self.key, mode="clip")
        r = self.ranges >> 16
        self.two = self.p2 * r
        self.one = (((_ONE - self.p2) * self.p1) >> 16) * r
        self.both = self.two + self.one
        self.unit = ((r << 16) - self.both) >> self.by

    def narrow(self, x: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> np.ndarray:
        """Leave of the range the ids' parts; where those begin."""
        self.at = self.at_ids + x
        place = self.place.take(self.at, mode="clip")
        start = self.both + (place & 0xFFFF) * self.unit
        size = (place >> 16) * self.unit
        np.copyto(start, self.two, where=hit1)
        np.copyto(size, self.one, where=hit1)
        np.copyto(start, 0, where=hit2)
        np.copyto(size, self.two, where=hit2)
        self.ranges[:] = size
        return start

    def learn(self, x: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, same2: np.ndarray, same1: np.ndarray) -> None:
        # what is 0 stays 0, as LEAST // 16 is 0
        self.share[0][self.key] = self.p2 + ((_TARGET.take(hit2) - self.p2) >> 4)
        p1 = self.p1 + ((_TARGET.take(hit1) - self.p1) >> 4)
        np.copyto(p1, self.p1, where=hit2)
        self.share[1][self.key] = p1
        new = (x << 2) + 1
        for slots, at, w, k, same in ((self.slots[0], self.at2, self.w2, self.k2, same2), (self.slots[1], self.at1, self.w1, self.k1, same1)):
            other = w - 1
            np.copyto(other, new, where=k < 2)
            np.copyto(other, w + (k < 3), where=same)
            slots[at] = other
        self.count[self.at] += ~(hit2 | hit1)
        self.z, self.a = self.a, x


def encode(parts: list[np.ndarray], n_ids: np.ndarray) -> list[np.ndarray]:
    """16-bit digits of each part; a part holds numbers below its n_ids. Longest part first."""
    lengths = np.array([len(x) for x in parts])
    s = _Lanes(lengths, n_ids)
    b, steps = len(parts), int(lengths.max(initial=0))
    ids = np.zeros((steps, b), np.int32)
    for i, x in enumerate(parts):
        ids[:len(x), i] = x
    low = np.zeros(b, np.int64)
    out = np.zeros((steps // 2 + 8, b), np.uint32)
    used = np.zeros(b, np.int64)
    longer = np.searchsorted(-lengths, -np.arange(steps), "left").tolist()  # parts longer than each step

    def shift(at: np.ndarray) -> None:
        nonlocal out
        to, digit = used[at], low[at]
        if to.max(initial=0) >= len(out):
            out = np.concatenate([out, np.zeros_like(out)])
        out.reshape(-1)[to * b + at] = digit >> 32
        used[at] = to + 1
        low[at] = (digit & _LOW32) << 16
        s.range[at] <<= 16

    for first, end, m in s.stretches():
        s.renew(m, False)
        s.enter(m)
        lows = low[:m]
        for t in range(first, end):
            x = ids[t, :m]
            s.predict()
            same2, same1 = x == s.c2, x == s.c1
            hit2 = same2 & (s.two > 0)
            hit1 = same1 & (s.one > 0) & ~hit2
            start = s.narrow(x, hit2, hit1)
            if longer[t] < m:  # a part that has ended writes no more
                start[longer[t]:] = 0
                s.ranges[longer[t]:] = 2**48 - 1
            lows += start
            at = np.flatnonzero(s.ranges <= _LOW32)
            while len(at):
                shift(at)
                at = at[s.range[at] <= _LOW32]
            s.learn(x, hit2, hit1, same2, same1)
        s.leave(m)
    every = np.arange(b)
    for _ in range(3):
        shift(every)
    carry = np.zeros(b, np.uint32)
    for k in range(int(used.max(initial=0)) - 1, -1, -1):  # a digit may hold a carry into the one before
        whole = out[k] + carry
        carry = whole >> np.uint32(16)
        out[k] = whole & np.uint32(0xFFFF)
    return [out[:used[i], i].astype("<u2") for i in range(b)]


def decode(digits: list[np.ndarray], lengths: np.ndarray, n_ids: np.ndarray) -> list[np.ndarray]:
    """The numbers of each part. Longest part first."""
    s = _Lanes(lengths, n_ids)
    b = len(digits)
    code_in = np.zeros((max(map(len, digits), default=0) + 4, b), np.uint16)
    for i, x in enumerate(digits):
        code_in[:len(x), i] = x
    code = (code_in[0].astype(np.int64) << 32) | (code_in[1].astype(np.int64) << 16) | code_in[2]
    code_in = code_in.ravel()
    to = np.arange(b) + 3 * b
    ids = np.zeros((int(lengths.max(initial=0)), b), np.int32)
    for first, end, m in s.stretches():
        holds = s.renew(m, True)
        s.enter(m)
        codes = code[:m]
        row = np.arange(m) * (len(holds) // m)
        most = s.units[:m].astype(np.uint64) - np.uint64(1)
        for t in range(first, end):  # a part that has ended goes on, with numbers that nobody takes
            s.predict()
            hit2 = codes < s.two
            hit1 = (codes < s.both) & ~hit2
            unit = np.minimum((codes - s.both).view(np.uint64) // s.unit.view(np.uint64), most).view(np.int64)
            x = holds.take(row + unit, mode="clip").astype(np.int32)
            np.copyto(x, s.c1, where=hit1)
            np.copyto(x, s.c2, where=hit2)
            codes -= s.narrow(x, hit2, hit1)
            at = np.flatnonzero(s.ranges <= _LOW32)
            while len(at):
                place = to[at]
                code[at] = (code[at] << 16) | code_in.take(place, mode="clip")
                to[at] = place + b
                s.range[at] <<= 16
                at = at[s.range[at] <= _LOW32]
            s.learn(x, hit2, hit1, x == s.c2, x == s.c1)
            ids[t, :m] = x
        s.leave(m)
    return [ids[:n, i] for i, n in enumerate(lengths.tolist())]


def _cuts(length: int) -> np.ndarray:
    """Where the parts of a block begin, and its end."""
    parts = max(1, -(-length // BLOCK))
    return np.arange(parts + 1) * length // parts


def _side_by_side(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Parts in groups of like length, longest first in each."""
    order = np.argsort(-lengths, kind="stable")
    for at in range(0, len(order), LANES):
        yield order[at:at + LANES]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    cuts = [_cuts(len(x)) for x in blocks]
    names = [np.unique(x[a:z], return_inverse=True) for x, at in zip(blocks, cuts, strict=True)
             for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    digits: list[np.ndarray] = [np.zeros(0, "<u2")] * len(names)
    for group in _side_by_side(np.array([len(x) for _, x in names])):
        coded = encode([names[i][1] for i in group], np.array([len(names[i][0]) for i in group]))
        for i, d in zip(group.tolist(), coded, strict=True):
            digits[i] = d
    out, first = [], 0
    for at in cuts:
        own, coded = [], digits[first:first + len(at) - 1]
        for ids, _ in names[first:first + len(at) - 1]:
            own.append(zstandard.compress(np.diff(ids.astype(np.int64), prepend=0).astype("<u4").tobytes(), 3))
        first += len(at) - 1
        head = np.array([[len(x), len(d)] for x, d in zip(own, coded, strict=True)], "<u4").tobytes()
        out.append(b"".join([head] + [y for x, d in zip(own, coded, strict=True) for y in (x, d.tobytes())]))
    return out


def decode_blocks(data: list[bytes], lengths: np.ndarray) -> list[np.ndarray]:
    cuts = [_cuts(n) for n in lengths.tolist()]
    digits, names = [], []
    for x, at in zip(data, cuts, strict=True):
        to = 8 * (len(at) - 1)
        for n_own, n_digits in np.frombuffer(x[:to], "<u4").reshape(-1, 2).tolist():
            own = np.frombuffer(zstandard.decompress(x[to:to + n_own]), "<u4")
            names.append(np.cumsum(own, dtype=np.int64).astype("<u4"))
            digits.append(np.frombuffer(x, "<u2", n_digits, to + n_own))
            to += n_own + 2 * n_digits
    parts: list[np.ndarray] = [np.zeros(0, "<u4")] * len(names)
    sizes = np.concatenate([np.diff(at) for at in cuts] + [np.zeros(0, np.int64)])
    for group in _side_by_side(sizes):
        got = decode([digits[i] for i in group], sizes[group], np.array([len(names[i]) for i in group]))
        for i, x in zip(group.tolist(), got, strict=True):
            parts[i] = names[i][x]
    first = np.cumsum([0] + [len(at) - 1 for at in cuts]).tolist()
    return [np.concatenate(parts[a:z]) if z - a > 1 else parts[a] for a, z in zip(first[:-1], first[1:], strict=True)]


def write(docs: DataFrame, path: str, end: int = END, vocabulary_name: str = VOCABULARY, id_col: str = "doc_id",
          text_col: str = "text", block: int = BLOCK) -> None:
    """Write the ids of all documents, in ascending order of their id, as files of coded blocks under ``path``."""
    spark = docs.sparkSession
    Scratch(spark, "ids")
    names = vocabulary(vocabulary_name)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = buckets(spark, size, PER_SHARD)
    # shard borders from quantiles of the ids: bounded by the number of shards
    cuts = rows.where("id is not null").agg(
        F.percentile_approx("id", [i / shards for i in range(1, shards)] or [0.5], 100 * shards)).first()[0] or []
    cuts = sorted(set(cuts))
    shard = F.aggregate(F.array(*[F.lit(c) for c in cuts]).cast(f"array<{kind}>"), F.lit(0),
                        lambda n, c: n + (F.col("id") > c).cast("int"))
    rows = rows.withColumn("shard", F.when(F.col("id").isNull(), len(cuts) + 1).otherwise(shard)).withColumn(
        "tie", F.xxhash64("text"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, n, ids, off in encoded(b.column("text"), names):
                wide = "<u2" if ids.max(initial=0) < 2**16 and end < 2**16 else "<u4"
                raw = [np.append(ids[off[i]:off[i + 1]], np.uint32(end)).astype(wide).tobytes() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("shard").slice(first, n), b.column("id").slice(first, n), b.column("tie").slice(first, n),
                     pa.array([int(wide[2])] * n, pa.int32()), pa.array(raw, pa.binary())],
                    ["shard", "id", "tie", "wide", "ids"])

    def code(table: pa.Table) -> pa.Table:
        table = table.take(pa.compute.sort_indices(table, [("id", "ascending"), ("tie", "ascending")]))
        ids = [np.frombuffer(x.as_py(), f"<u{w}").astype("<u4")
               for x, w in zip(table["ids"], table["wide"].to_pylist(), strict=True)]
        n = np.array([len(x) for x in ids])
        begin = [0]
        total = 0
        for i, k in enumerate(n.tolist()):
            if total and total + k > block:
                begin.append(i)
                total = 0
            total += k
        spans = list(zip(begin, [*begin[1:], len(ids)], strict=True))
        blocks = [np.concatenate(ids[a:z]) for a, z in spans]
        docs_of = pa.ListArray.from_arrays(pa.array([*begin, len(ids)], pa.int32()), table["id"].combine_chunks())
        sizes = pa.ListArray.from_arrays(pa.array([*begin, len(ids)], pa.int32()), pa.array(n, pa.int32()))
        return pa.table({"shard": pa.array([table["shard"][0].as_py()] * len(blocks), pa.int32()),
                         "block": pa.array(range(len(blocks)), pa.int32()), "doc_ids": docs_of, "lengths": sizes,
                         "crc32": pa.array([zlib.crc32(x.tobytes()) for x in blocks], pa.int64()),
                         "data": pa.array(encode_blocks(blocks), pa.binary())})

    coded = (rows.select("shard", "id", "tie", "text")
             .mapInArrow(tokens, f"shard int, id {kind}, tie bigint, wide int, ids binary").groupBy("shard")
             .applyInArrow(code, f"shard int, block int, doc_ids array<{kind}>, lengths array<int>, crc32 bigint, data binary"))
    coded.write.parquet(path)


def read(spark, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files under ``path``.

    Every block is decoded and its ids are held against the block's checksum.
    """
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, LANES):
                part = b.slice(at, LANES)
                sizes = [np.asarray(x.values) for x in part.column("lengths")]
                blocks = decode_blocks([x.as_py() for x in part.column("data")], np.array([int(x.sum()) for x in sizes]))
                of, where, n, crc, kept = [], [], [], [], []
                for i, (ids, size) in enumerate(zip(blocks, sizes, strict=True)):
                    if zlib.crc32(ids.tobytes()) != part.column("crc32")[i].as_py():
                        raise ValueError(f"block {part.column('block')[i]} of shard {part.column('shard')[i]} is damaged")
                    stop = np.cumsum(size)
                    for a, z in zip((stop - size).tolist(), stop.tolist(), strict=True):
                        of.append(i)
                        where.append(a)
                        n.append(z - a)
                        crc.append(zlib.crc32(ids[a:z].tobytes()))
                        if with_ids:
                            kept.append(ids[a:z].astype(np.int32))
                cols = {"doc_id": part.column("doc_ids").flatten(), "shard": part.column("shard").take(pa.array(of, pa.int32())),
                        "block": part.column("block").take(pa.array(of, pa.int32())), "at": pa.array(where, pa.int64()),
                        "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
                if with_ids:
                    cols["ids"] = pa.array(kept, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(cols)

    schema = f"doc_id {kind}, shard int, block int, at bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    found = files.mapInArrow(run, schema)
    # where blocks begin: sums over a shard's blocks, and over shards
    size = files.select("shard", "block", F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("size"))
    ahead = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shards = size.groupBy("shard").agg(F.sum("size").alias("size"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    base = shards.select("shard", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    begins = size.select("shard", "block", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("begin")).join(base, "shard")
    extra = ["ids"] if with_ids else []
    return found.join(begins, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *extra)


def op2_id_coder(spark, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "id-files").folder
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read(spark, path)
