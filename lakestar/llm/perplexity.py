"""Quality rules: perplexity under a modified Kneser-Ney n-gram model, in language-specific bands.

The n-grams are of ``ORDER`` bytes, about a word and its neighbour's edge, one model per language, counted over all texts.
No model is ever whole in one place. Tasks combine the counts of their texts and send them, packed, to buckets by
(language, the three bytes before the last one), so an n-gram meets all others of its context, and all whose tails it shares
down to four bytes: a bucket has what the counts and continuation counts of orders 4 to ``ORDER`` need. Orders 1 to 3 and the
discounts come from sums over a language's buckets, at most 256**3 trigrams each, and go back to the buckets. Scoring asks:
each slice of text sends its distinct n-grams to the buckets, gets one log probability (in whole 1 / ``GRAIN``) for
each, and adds them up by document. Every n-gram asked for has been counted, as the texts scored are those learned from.
The rows are read once to ask and once to add up, in the same slices if they come in the same order both times, as they do
from files; checksums tell if they do not, and the job fails then.

A document's perplexity is taken per byte, over its bytes and ``PRIOR_BYTES`` more of the language's median, so that a short
text does not look extreme. A language's band reaches from its lower quartile
minus ``FENCE`` times the quartiles' distance (of log perplexity, over documents that pass the
base rules) to its upper quartile plus as much. Documents outside are rejected.

Null texts are empty: they have no words and fail the base rules. A null language is a
language of its own. Repeated rows are judged each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm import words as W
from lakestar.llm.scratch import Scratch

ORDER = 6              # bytes of an n-gram
GRAIN = 1 << 12        # log probabilities of n-grams travel as whole parts of this size
SENT = 16 << 20        # bytes of text whose n-grams are asked for at once
HELD = 4_000_000       # distinct n-grams that a task combines before it sends their counts
PER_BUCKET = 64 << 20  # bytes of text of a bucket
MIN_BUCKETS = 16
FENCE = 3.0
PRIOR_BYTES = 300
LEAST_SPREAD = 0.02  # of the quartiles, in log10 perplexity: equal documents must not make a band of no width
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
_ORDER_KEY = [np.uint64(k) << np.uint64(40) for k in range(4)]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def grams(buf: np.ndarray, off: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The code of each byte with those before it in its text, ``order`` in all; a text begins with zero bytes."""
    lead = order - 1
    at = np.arange(len(buf)) + np.repeat(np.arange(1, len(off)) * lead, np.diff(off))
    padded = np.zeros(len(buf) + lead * len(off), np.uint64)
    padded[at] = buf
    code = padded.copy()
    for k in range(1, order):
        code[k:] |= padded[:-k] << np.uint64(8 * k)
    return code[at]


def trigrams(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    return grams(buf, off, 3)


def by_language(langs: pa.Array, texts: pa.LargeStringArray) -> Iterator[tuple[str | None, np.ndarray]]:
    """(language, rows) within a slice."""
    coded = langs.cast(pa.string()).dictionary_encode()
    of = pc.fill_null(coded.indices, -1).to_numpy()
    for k in np.unique(of):
        yield (None if k < 0 else coded.dictionary[int(k)].as_py()), np.flatnonzero(of == k)


def tongue(lang: Column) -> Column:
    """A key for a language, null included."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def _pack(code: np.ndarray, *more: tuple[np.ndarray, int]) -> bytes:
    """Ascending codes as steps, and numbers of so many bytes; all first bytes come before all second ones."""
    cols = [(np.diff(code, prepend=np.uint64(0)), 6), *more]
    return zstandard.compress(b"".join(
        np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].T).tobytes() for x, k in cols), 1)


def _unpack(raw: bytes, *more: int) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.decompress(raw), np.uint8)
    sizes = (6, *more)
    n = len(data) // sum(sizes)
    out, at = [], 0
    for k in sizes:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :k] = data[at:at + k * n].reshape(k, n).T
        out.append(wide.view("<u8").ravel())
        at += k * n
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _add_up(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(code, return_inverse=True)
    return code, np.bincount(at, n, len(code)).astype(np.int64)


def _by_bucket(code: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of ascending codes by bucket, and each bucket's (number, begin, end) in it."""
    of = (W.mix((code >> np.uint64(8)) & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[order], np.arange(buckets + 1))
    return order, [(k, int(a), int(z)) for k, (a, z) in enumerate(zip(ends, ends[1:], strict=False)) if z > a]


def counts(rows: DataFrame, buckets: int) -> DataFrame:
    """(key, bucket, block): packed n-grams with how often they occur in texts of a task, from (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for first, texts in W.slices(b.column(1)):
                for key, rows in by_language(b.column(0).slice(first, len(texts)), texts):
                    code, n = np.unique(grams(*W.raw(texts.take(pa.array(rows)))), return_counts=True)
                    if key in held:
                        code, n = _add_up(np.r_[held[key][0], code], np.r_[held[key][1], n])
                    held[key] = code, n
                if sum(len(code) for code, _ in held.values()) > HELD:
                    yield from sent(held)
                    held = {}
        yield from sent(held)
        W.give_back()

    def sent(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for key, (code, n) in held.items():
            order, parts = _by_bucket(code, buckets)
            for k, a, z in parts:
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([key], pa.string()), "bucket": pa.array([k], pa.int32()),
                    "block": pa.array([_pack(code[order[a:z]], (n[order[a:z]], 6))], pa.binary())})

    return rows.select("key", "text").mapInArrow(run, "key string, bucket int, block binary")


def tails(code: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(codes, counts) of orders 3 to ORDER; below ORDER continuation counts: in how many n-grams one order up it is the tail."""
    levels = [(code, n)]
    for k in range(ORDER - 1, 2, -1):
        tail, c = np.unique(levels[0][0] & np.uint64((1 << 8 * k) - 1), return_counts=True)
        levels.insert(0, (tail, c))
    return levels


def merged(table: pa.Table) -> pa.Table:
    """A bucket's n-grams with their counts, its share of the trigrams' counts, and how many counts are 1, 2, 3 and 4 by order."""
    parts = [_unpack(x.as_py(), 6) for x in table["block"]]
    code, n = _add_up(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    (tri, c), *upper = tails(code, n)
    few = [int((x == k).sum()) for _, x in upper for k in (1, 2, 3, 4)]
    return pa.table({"key": table["key"][:1], "bucket": table["bucket"][:1],
                     "block": pa.array([_pack(code, (n, 6))], pa.binary()),
                     "tri": pa.array([_pack(tri, (c, 6))], pa.binary()), "few": pa.array([few], pa.list_(pa.int64()))})


def lowered(table: pa.Table) -> pa.Table:
    """For each bucket of a language: log10 probabilities of its trigrams, and the discounts of the orders above."""
    parts = [_unpack(x.as_py(), 6) for x in table["tri"]]
    code, n = _add_up(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    log = Model(code, n).log10(code)
    few = np.sum([x.as_py() for x in table["few"]], axis=0).reshape(-1, 4)
    cut = [float(x) for row in few for x in discounts_of(*row.tolist())]
    return pa.table({"key": table["key"], "bucket": table["bucket"],
                     "lower": pa.array([log[np.searchsorted(code, own)].tobytes() for own, _ in parts], pa.binary()),
                     "cut": pa.array([cut] * len(parts), pa.list_(pa.float64()))})


def priced(bucket: pa.Table, lower: pa.Table) -> pa.Table:
    """A bucket's n-grams with their log10 probabilities."""
    levels = tails(*_unpack(bucket["block"][0].as_py(), 6))
    below, below_p = levels[0][0], 10 ** np.frombuffer(lower["lower"][0].as_py(), "<f8")
    cuts = np.array(lower["cut"][0].as_py()).reshape(-1, 4)
    for k, ((code, c), d) in enumerate(zip(levels[1:], cuts, strict=True), 4):
        cut = d[np.minimum(c, 3).astype(np.int64)]
        context, at = np.unique(code >> np.uint64(8), return_inverse=True)
        total = np.bincount(at, c)
        left = np.bincount(at, cut) / total  # what the discounts free, for the order below
        p = (c - cut) / total[at] + left[at] * below_p[np.searchsorted(below, code & np.uint64((1 << 8 * (k - 1)) - 1))]
        below, below_p = code, p
    log = np.minimum(np.rint(-np.log10(below_p) * GRAIN), 2**16 - 1)
    return pa.table({"key": bucket["key"], "bucket": bucket["bucket"],
                     "block": pa.array([_pack(below, (log, 2))], pa.binary())})


MERGED = "key string, bucket int, block binary, tri binary, few array<bigint>"


def fit(scratch: Scratch, rows: DataFrame, buckets: int) -> DataFrame:
    """(key, bucket, block): every n-gram of (key, text) with its log10 probability."""
    own = scratch.keep(counts(rows, buckets).groupBy("key", "bucket").applyInArrow(merged, MERGED), "counts")
    lower = own.select("key", "bucket", "tri", "few").groupBy("key").applyInArrow(
        lowered, "key string, bucket int, lower binary, cut array<double>")
    return own.groupBy("key", "bucket").cogroup(lower.groupBy("key", "bucket")).applyInArrow(
        priced, "key string, bucket int, block binary")


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2, and 3 or more."""
    return discounts_of(*(float((n == k).sum()) for k in (1, 2, 3, 4)))


def discounts_of(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """The same, from how many counts are 1, 2, 3 and 4."""
    if min(n1, n2, n3) == 0:
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0, [0, 0.99, 1.99, 2.99])


class Model:
    """Orders 1 to 3 of a language: sorted hashes of n-grams with log10 probabilities, and of contexts with log10 back-off weights."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        order = np.argsort(gram)
        levels = [(gram[order].astype(np.int64), n[order].astype(np.int64))]
        for bits in (16, 8):  # continuation counts: in how many n-grams one order up it is the tail
            tail, c = np.unique(levels[0][0] & ((1 << bits) - 1), return_counts=True)
            levels.insert(0, (tail, c))
        keys, log_p, contexts, back = [], [], [], []
        lower_p = np.full(256, 1 / 256)  # by tail
        self.unseen = 0.0
        lower = np.arange(256)
        for k, (code, c) in enumerate(levels, 1):
            d = discounts(c)
            cut = d[np.minimum(c, 3)]
            context, at = np.unique(code >> 8, return_inverse=True)
            total = np.bincount(at, c)
            left = np.bincount(at, cut) / total  # what the discounts free, for the order below
            tail = code & ((1 << 8 * (k - 1)) - 1) if k > 1 else code
            p = (c - cut) / total[at] + left[at] * lower_p[np.searchsorted(lower, tail)]
            keys.append(self.key(k, code))
            log_p.append(np.log10(p))
            if k == 1:
                self.unseen = float(np.log10(left[0] / 256)) if left[0] > 0 else -10.0
            else:
                contexts.append(self.key(k - 1, context))
                back.append(np.log10(np.maximum(left, 1e-12)))
            lower, lower_p = code, p
        self.keys, self.log_p = self._sorted(keys, log_p)
        self.contexts, self.back = self._sorted(contexts, back)

    @staticmethod
    def _sorted(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        key = np.concatenate(keys)
        order = np.argsort(key)
        return key[order], np.concatenate(values)[order]

    @staticmethod
    def key(order: int, code: np.ndarray) -> np.ndarray:
        return W.mix(code.astype(np.uint64) + _ORDER_KEY[order])

    def find(self, keys: np.ndarray, order: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.key(order, code)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return at, keys[at] == key

    def log10(self, gram: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each trigram code given the two before it."""
        out, weight = np.zeros(len(gram)), np.zeros(len(gram))
        left = np.arange(len(gram))
        for k in (3, 2, 1):
            code = gram[left].astype(np.int64) & ((1 << 8 * k) - 1)
            at, hit = self.find(self.keys, k, code)
            out[left[hit]] = weight[left[hit]] + self.log_p[at[hit]]
            left, code = left[~hit], code[~hit]
            if k > 1:
                at, hit = self.find(self.contexts, k - 1, code >> 8)
                weight[left] += np.where(hit, self.back[at], 0)
        out[left] = weight[left] + self.unseen
        return out


def statistics(texts: pa.LargeStringArray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    w = W.words(texts)
    n, total = len(texts), len(w.buf)

    def per_text(mark: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(mark)][w.text_off])

    inside = ~W.SPACE[w.buf]
    out = {"n_words": w.counts(), "word_chars": per_text(inside & ((w.buf & 0xC0) != 0x80)),
           "n_symbols": per_text(_SYMBOL[w.buf])}

    # lines: begin at each text and after each \n
    new = np.zeros(total + 1, bool)
    new[w.text_off] = True
    new[1:][w.buf == 10] = True
    start = np.flatnonzero(new[:total])
    of = np.searchsorted(w.text_off, start, "right") - 1
    if len(start):
        within = np.arange(total) - np.repeat(start, np.diff(np.r_[start, total]))
        value = W._BYTE_CASED[w.buf] * W.powers(int(within.max()) + 1)[within]
        value[w.buf == 10] = 0  # the line's end is no part of it
        length = np.add.reduceat((w.buf != 10).astype(np.uint64), start)
        line = W.mix(np.add.reduceat(value, start) + length)
        worded = np.add.reduceat(inside.astype(np.int64), start) > 0
        line, of = line[worded], of[worded]
    else:
        line, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    order = np.lexsort((line, of))
    same = (line[order][1:] == line[order][:-1]) & (of[order][1:] == of[order][:-1])
    out["n_dup_lines"] = np.bincount(of[order][1:][same], minlength=n)

    h, of = w.hashes(cased=True), w.text_of()
    covered = np.zeros(len(h) + 1, np.int64)
    if len(h) >= WINDOW:
        run = np.zeros(len(h) - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            run = W.mix(run * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - WINDOW + 1 + k] + np.uint64(1))
        at = np.flatnonzero(of[WINDOW - 1:] == of[:len(run)])
        order = at[np.lexsort((run[at], of[at]))]
        same = (run[order][1:] == run[order][:-1]) & (of[order][1:] == of[order][:-1])
        twice = order[np.r_[same, False] | np.r_[False, same]] if len(order) else order
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(of[np.cumsum(covered)[:-1] > 0], minlength=n)
    return out


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, pa.LargeStringArray]]:
    """(number, rows, texts) of a task's (id, key, text), in slices of about SENT bytes of text."""
    number = TaskContext.get().partitionId() << 32
    for b in batches:
        for first, texts in W.slices(b.column(2), SENT):
            yield number, b.slice(first, len(texts)), texts
            number += 1


def _coded(keys: pa.Array, texts: pa.LargeStringArray) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, rows, distinct codes, place of each byte's code among them, byte offsets) by language and run of texts."""
    for first, part in W.slices(texts):
        for key, rows in by_language(keys.slice(first, len(part)), part):
            buf, off = W.raw(part.take(pa.array(rows)))
            code, at = np.unique(grams(buf, off), return_inverse=True)
            yield key, rows + first, code, at.astype(np.int32), off


def _distinct(coded: list[tuple]) -> dict[str, np.ndarray]:
    """The distinct codes of each language."""
    found: dict[str, list[np.ndarray]] = {}
    for key, _, code, *_ in coded:
        found.setdefault(key, []).append(code)
    return {key: np.unique(np.concatenate(x)) for key, x in found.items()}


def asked(rows: DataFrame, buckets: int) -> DataFrame:
    """(key, bucket, slice, block): the distinct n-grams of every slice of (id, key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, b, texts in _slices(batches):
            for key, code in _distinct([(*x[:3],) for x in _coded(b.column(1), texts)]).items():
                order, parts = _by_bucket(code, buckets)
                for k, a, z in parts:
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([key], pa.string()), "bucket": pa.array([k], pa.int32()),
                        "slice": pa.array([number], pa.int64()),
                        "block": pa.array([_pack(code[order[a:z]])], pa.binary())})
            W.give_back()

    return rows.mapInArrow(run, "key string, bucket int, slice bigint, block binary")


def answered(asked: pa.Table, model: pa.Table) -> pa.Table:
    """For each slice the log10 probabilities of what it asked a bucket for, and the checksum of that."""
    known, log = _unpack(model["block"][0].as_py(), 2)
    crc, out = [], []
    for x in asked["block"]:
        code = _unpack(x.as_py())[0]
        crc.append(zlib.crc32(code.tobytes()))
        mine = log[np.searchsorted(known, code)].astype("<u2").view(np.uint8).reshape(-1, 2)
        out.append(zstandard.compress(np.ascontiguousarray(mine.T).tobytes(), 1))
    return pa.table({"slice": asked["slice"], "key": asked["key"], "bucket": asked["bucket"],
                     "crc": pa.array(crc, pa.int64()), "block": pa.array(out, pa.binary())})


def packed(rows: DataFrame) -> DataFrame:
    """(slice, rows): the rows of every slice of (id, key, text), compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, b, _ in _slices(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as to:
                to.write_batch(b)
            yield pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int64()),
                                              "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    return rows.mapInArrow(run, "slice bigint, rows binary")


def measured(rows: DataFrame, model: DataFrame, buckets: int) -> DataFrame:
    """(id, key, STATS..., n_bytes, log10_p): the rules' figures and the model's log probability of every text."""
    kind = rows.schema["id"].dataType.simpleString()

    def score(own: pa.Table, logs: pa.Table) -> pa.Table:
        b = pa.ipc.open_stream(own["rows"][0].as_py()).read_all().combine_chunks().to_batches()[0]
        texts = pc.fill_null(b.column(2).cast(pa.large_string()), "")
        told = {(k, n): (crc, x) for k, n, crc, x in zip(
            logs["key"].to_pylist(), logs["bucket"].to_pylist(), logs["crc"].to_pylist(), logs["block"], strict=True)}
        coded = list(_coded(b.column(1), texts))
        known = {}
        for key, code in _distinct(coded).items():
            order, parts = _by_bucket(code, buckets)
            log = np.zeros(len(code), np.int64)
            for k, a, z in parts:
                crc, block = told.get((key, k), (None, None))
                if crc != zlib.crc32(code[order[a:z]].tobytes()):
                    raise ValueError("the texts were not read in the same slices twice")
                low, high = np.frombuffer(zstandard.decompress(block.as_py()), np.uint8).reshape(2, -1).astype(np.int64)
                log[order[a:z]] = low + (high << 8)
            known[key] = code, log
        n_bytes, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for key, at, code, of, off in coded:
            every, log = known[key]
            n_bytes[at] = np.diff(off)
            total[at] = np.diff(np.r_[0, np.cumsum(log[np.searchsorted(every, code)][of])][off])
        del coded, known
        stats = [statistics(x) for _, x in W.slices(texts)]
        W.give_back()
        return pa.table({"id": b.column(0), "key": b.column(1),
                         **{x: pa.array(np.concatenate([s[x] for s in stats]), pa.int64()) for x in STATS},
                         "n_bytes": pa.array(n_bytes), "log10_p": pa.array(total / -GRAIN)})

    logs = asked(rows, buckets).groupBy("key", "bucket").cogroup(model.groupBy("key", "bucket")).applyInArrow(
        answered, "slice bigint, key string, bucket int, crc bigint, block binary")
    return packed(rows).groupBy("slice").cogroup(logs.groupBy("slice")).applyInArrow(
        score, f"id {kind}, key string, {', '.join(f'{x} bigint' for x in STATS)}, n_bytes bigint, log10_p double")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           fence: float = FENCE) -> DataFrame:
    """(id, STATS..., base_failed, kept, log10_perplexity, lower, upper): one row per document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "perplexity")
    texts = docs.select(F.col(id_col).alias("id"), tongue(F.col(lang_col)).alias("key"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-size // PER_BUCKET))
    rows = scratch.keep(measured(texts, fit(scratch, texts, buckets), buckets), "measured")
    rows = (rows.withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")))
    middle = (rows.where("not base_failed").groupBy(F.col("key").alias("middle_key")).agg(
        F.percentile_approx(-F.col("log10_p") / F.col("n_bytes"), 0.5, 10000).alias("middle")))
    rows = (rows.join(F.broadcast(middle), F.col("key") == F.col("middle_key"), "left")
            .withColumn("log10_perplexity", (PRIOR_BYTES * F.col("middle") - F.col("log10_p"))
                        / (PRIOR_BYTES + F.col("n_bytes"))))
    q = F.percentile_approx("log10_perplexity", [0.25, 0.75], 10000)
    spread = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(LEAST_SPREAD))
    bands = (rows.where("not base_failed").groupBy(F.col("key").alias("band_key")).agg(q.alias("q"))
             .select("band_key", (F.col("q")[0] - fence * spread).alias("lower"),
                     (F.col("q")[1] + fence * spread).alias("upper")))
    inside = F.col("log10_perplexity").between(F.col("lower"), F.col("upper"))
    return (rows.join(F.broadcast(bands), F.col("key") == F.col("band_key"), "left")
            .select(F.col("id").alias(id_col), *STATS, "base_failed",
                    (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
                    "log10_perplexity", "lower", "upper"))


def op5_ngram_perplexity(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
