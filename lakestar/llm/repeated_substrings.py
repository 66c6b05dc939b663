"""Suffix-array deduplication: bytes of passages that occur elsewhere, by previous factors in suffix order.

A passage is any string of ``LENGTH`` bytes. Where it occurs a second time, in another document or the same,
it has an earlier occurrence there: its longest previous factor is at least LENGTH long. Only that is decided;
the lengths of shorter factors are not worked out, as nothing goes by them.

1. Every window of LENGTH bytes has an anchor: the smallest of its hashed 32-byte grams, leftmost first. Equal
   windows have equal anchors at equal offsets, and neighbours share one, so there is one anchor for
   about 85 bytes. Spark counts anchors; windows whose anchor occurs once cannot repeat.
2. Documents are dealt to buckets by a hash. A bucket sends, for each repeated anchor, the segment of bytes
   that its windows span, once however often it occurs in the bucket.
3. Segments meet by anchor. There a suffix array of the segments to depth LENGTH is built by prefix tripling
   (8, 24, 72, then LENGTH bytes, in byte order). In suffix order, ties by text position, the previous smaller
   position of a suffix is its predecessor among those that agree to that depth; the next smaller one lies
   beyond them. So all but the first of such a run have a previous factor of LENGTH or more.
4. An anchor whose distinct segments weigh more than PER_ANCHOR bytes (a phrase shorter than a passage, with
   other words around it in every document) has no suffix array of its own: each of its windows becomes a row under the
   window's 128-bit digest, and counts and first places by digest, combined before the shuffle, tell the same.
5. Which windows repeat, and which are the first of their run, goes back to the buckets that
   sent the segment; they mark bytes in their documents.

A frequent passage costs one segment per bucket, not per document. Texts travel between tasks as compressed
blocks. A null text is empty. Order of text is (id, position), null ids last; rows that repeat both id and text
count as two occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm import words as W
from lakestar.llm.scratch import Scratch, buckets

LENGTH = 200
GRAM = 32
SLICE = 1 << 20
PER_BUCKET = 8 << 20   # bytes of text of a bucket
PER_SORT = 1 << 20     # bytes of segments of a suffix array
PER_ANCHOR = 8 << 20   # bytes of one anchor's segments in a suffix array; beyond, its windows meet by digest
_INVERSE = np.uint64(pow(int(W._BASE), -1, 2**64))
_steps = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_steps[0]) < n:
        for i, base in enumerate((W._BASE, _INVERSE)):
            x = np.full(max(n, SLICE), base)
            x[0] = 1
            _steps[i] = np.cumprod(x, dtype=np.uint64)
    return _steps[0][:n], _steps[1][:n]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    blocks = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    blocks[:n] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(buf: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, gram hash) of each anchor; windows by their place in buf."""
    n = len(buf)
    valid = np.zeros(n + 1, np.int64)
    long = np.flatnonzero(np.diff(off) >= length)
    if not len(long):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(W._TABLE[buf] * up, out=total[1:])
    h = W.mix((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])
    bits = np.uint64(32)  # of the place; the same in slices of any size, so that equal windows break ties alike
    ranked = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
    least = sliding_min(ranked, length - GRAM + 1)
    np.add.at(valid, off[long], 1)
    np.add.at(valid, off[long + 1] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(valid)[:n] > 0)
    place = (least[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    lo, hi = at[first], at[np.r_[first[1:], len(at)] - 1]
    return np.searchsorted(off, lo, "right") - 1, lo, hi, h[place[first]]


def ranks(buf: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Ranks of the strings of ``length`` bytes (72 to 216) that begin at ``windows``, in byte order."""
    padded = np.concatenate([buf, np.zeros(8 + 3 * 72, np.uint8)])
    n = len(buf) + 3 * 72
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:n + k]
    rank = np.unique(key, return_inverse=True)[1]

    def triple(rank: np.ndarray, at: np.ndarray, one: int, two: int) -> np.ndarray:
        parts = [rank[np.minimum(at + d, len(rank) - 1)].astype(np.uint64) for d in (0, one, two)]
        for part in parts[1:]:  # pairs of ranks fit 64 bits, as a buffer has under 2**32 bytes
            parts[0] = np.unique((parts[0] << np.uint64(32)) | part, return_inverse=True)[1].astype(np.uint64)
        return parts[0]

    def packed(rank: np.ndarray, at: np.ndarray, one: int, two: int) -> np.ndarray:
        if rank.max(initial=0) >= 1 << 21:
            return triple(rank, at, one, two)
        parts = [rank[np.minimum(at + d, len(rank) - 1)].astype(np.uint64) for d in (0, one, two)]
        whole = (parts[0] << np.uint64(42)) | (parts[1] << np.uint64(21)) | parts[2]
        return np.unique(whole, return_inverse=True)[1]

    everywhere = np.arange(n)
    for step in (8, 24):
        rank = packed(rank, everywhere, step, 2 * step)
    return packed(rank, windows, (length - 72) // 2, length - 72)


def previous_factors(rank: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(has an earlier match, has a later match) to the ranks' depth, for suffixes at text positions.

    In suffix order with ties by position, the previous smaller position is the predecessor in the run.
    """
    order = np.lexsort((position, rank))
    same = rank[order][1:] == rank[order][:-1]
    earlier, later = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def _blocks(docs: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, block): documents (id, text) dealt by hash, as compressed Arrow streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in W.slices(b.column("text"), 16 << 20):
                part = pa.table({"id": b.column("id").slice(first, len(texts)), "text": texts})
                bucket = b.column("bucket").slice(first, len(texts)).to_numpy()
                order = np.argsort(bucket, kind="stable")
                for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema) as out:
                        out.write_table(part.take(pa.array(rows)))
                    raw = zstandard.compress(sink.getvalue().to_pybytes(), 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(bucket[rows[0]])], pa.int32()), pa.array([raw], pa.binary())], ["bucket", "block"])

    return docs.select("bucket", "id", "text").mapInArrow(run, "bucket int, block binary")


def _opened(table: pa.Table) -> pa.Table:
    parts = [pa.ipc.open_stream(zstandard.decompress(x.as_py())).read_all() for x in table["block"]]
    return pa.concat_tables(parts)


def _segments(texts: pa.LargeStringArray, hits: np.ndarray, length: int) -> Iterator[tuple]:
    """(text, first window in the text, bytes, anchor) of each anchor in ``hits`` (ascending)."""
    buf, off = W.raw(texts)
    of, lo, hi, h = anchors(buf, off, length)
    at = np.minimum(np.searchsorted(hits, h), max(len(hits) - 1, 0))
    raw = buf.tobytes()
    for i in np.flatnonzero(hits[at] == h).tolist() if len(hits) else []:
        yield int(of[i]), int(lo[i] - off[of[i]]), raw[lo[i]:hi[i] + length], int(h[i])


def _by_digest(segments: DataFrame, scratch: Scratch, kind: str, length: int) -> DataFrame:
    """(bucket, name, repeats, firsts, h, first_id, at) of segments with a window that occurs elsewhere, window by window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, 1024):
                part = b.slice(first, 1024)
                raws = part.column("raw").to_pylist()
                row = np.repeat(np.arange(len(raws)), [len(x) - length + 1 for x in raws])
                k = np.concatenate([np.arange(len(x) - length + 1, dtype=np.int32) for x in raws])
                digest = [xxhash.xxh3_128_digest(raws[i][j:j + length])
                          for i, j in zip(row.tolist(), k.tolist(), strict=True)]
                rows = part.select(["bucket", "name", "h", "n", "id", "at"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(k), pa.array(digest, pa.binary())], [*rows.schema.names, "k", "digest"])

    windows = scratch.keep(segments.select("bucket", "name", "h", "n", "id", "at", "raw").mapInArrow(
        cut, f"bucket int, name binary, h bigint, n int, id {kind}, at bigint, k int, digest binary"), "windows")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", (F.col("at") + F.col("k")).alias("at"), "bucket", "name")
    runs = windows.groupBy("digest").agg(F.sum("n").alias("all"), F.min(place).alias("lead")).where("all > 1")
    is_lead = ((F.col("lead.bucket") == F.col("bucket")) & (F.col("lead.name") == F.col("name"))
               & (F.col("lead.at") == F.col("at") + F.col("k")))
    marks = windows.join(runs, "digest").groupBy("bucket", "name").agg(
        F.min("h").alias("h"), F.first("id").alias("first_id"), F.min("at").alias("at"),
        F.collect_list("k").alias("repeats"), F.collect_list(F.when(is_lead, F.col("k"))).alias("firsts"))

    def bits(places: list[int]) -> bytes:
        mark = np.zeros(max(places, default=0) + 1, bool)
        mark[places] = True
        return np.packbits(mark).tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [pa.array([bits(x) for x in b.column(c).to_pylist()], pa.binary()) for c in ("repeats", "firsts")]
            yield pa.RecordBatch.from_arrays(
                [b.column("bucket"), b.column("name"), *packed, b.column("h"), b.column("first_id"), b.column("at")],
                ["bucket", "name", "repeats", "firsts", "h", "first_id", "at"])

    return marks.mapInArrow(
        pack, f"bucket int, name binary, repeats binary, firsts binary, h bigint, first_id {kind}, at bigint")


def _order(ids: pa.Array) -> np.ndarray:
    """A rank of each id, null ids last."""
    order = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
           keep_first: bool = True, with_text: bool = False, per_anchor: int = PER_ANCHOR) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256[, starts, ends][, kept text as binary].

    keep_first: the first occurrence of a passage stays, later ones go; otherwise every byte of a
    passage that occurs anywhere else goes. ``starts`` and ``ends`` are the removed byte spans.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "substrings")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = buckets(spark, size, PER_BUCKET)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "text"), F.lit(n_buckets)).cast("int"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in W.slices(b.column(1), SLICE):
                of, _, _, h = anchors(*W.raw(texts), length)
                bucket = b.column(0).slice(first, len(texts)).to_numpy()[of]
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(h.view(np.int64))], ["bucket", "h"])

    seen = (rows.select("bucket", "text").mapInArrow(found, "bucket int, h bigint")
            .groupBy("h", "bucket").agg(F.count("*").alias("n")))
    seen = scratch.keep(seen, "anchors")
    hits = scratch.keep(seen.join(seen.groupBy("h").agg(F.sum("n").alias("all")).where("all > 1").select("h"), "h")
                        .select("bucket", "h"), "hits")
    blocks = _blocks(rows, n_buckets)

    def send(block: pa.Table, hit: pa.Table) -> pa.Table:
        own = np.sort(hit["h"].to_numpy().view(np.uint64))
        out: dict[bytes, list] = {}
        if block.num_rows:
            part = _opened(block)
            ids, order, base = part["id"].combine_chunks(), None, 0
            order = _order(ids)
            for first, texts in W.slices(part["text"], SLICE):
                for of, lo, raw, h in _segments(texts, own, length):
                    name = xxhash.xxh3_128_digest(raw)
                    here = (int(order[first + of]), lo, first + of)
                    if (held := out.get(name)) is None:
                        out[name] = [h, raw, 1, here]
                    else:
                        held[2] += 1
                        held[3] = min(held[3], here)
            base = block["bucket"][0].as_py()
            got = list(out.values())
            return pa.table({
                "bucket": pa.array([base] * len(got), pa.int32()), "name": pa.array(list(out), pa.binary()),
                "h": pa.array(np.array([x[0] for x in got], np.uint64).view(np.int64)),
                "raw": pa.array([x[1] for x in got], pa.binary()), "n": pa.array([x[2] for x in got], pa.int32()),
                "id": ids.take(pa.array([x[3][2] for x in got], pa.int64())),
                "at": pa.array([x[3][1] for x in got], pa.int64())})
        return pa.table({"bucket": pa.array([], pa.int32()), "name": pa.array([], pa.binary()),
                         "h": pa.array([], pa.int64()), "raw": pa.array([], pa.binary()), "n": pa.array([], pa.int32()),
                         "id": pa.array([], block["id"].type if "id" in block.column_names else pa.int64()),
                         "at": pa.array([], pa.int64())})

    sent = scratch.keep(blocks.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInArrow(
        send, f"bucket int, name binary, h bigint, raw binary, n int, id {kind}, at bigint"), "segments")
    weight = sent.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    n_sorts = buckets(spark, weight, PER_SORT)
    heavy = scratch.keep(sent.groupBy("h").agg(F.sum(F.octet_length("raw")).alias("weight"))
                         .where(F.col("weight") > per_anchor).select("h"), "heavy")

    def judge(table: pa.Table) -> pa.Table:
        raws = [x.as_py() for x in table["raw"].combine_chunks()]
        names = [x.as_py() for x in table["name"].combine_chunks()]
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(x, len(number)) for x in names])
        one = [raws[i] for i in np.unique(which, return_index=True)[1]]
        text_rank = np.lexsort((table["at"].to_numpy(), _order(table["id"].combine_chunks())))
        place = np.empty(len(text_rank), np.int64)
        place[text_rank] = np.arange(len(text_rank))  # rank of each row's first occurrence in the text order
        sizes = np.array([len(x) for x in one])
        buf = np.frombuffer(b"".join(one), np.uint8)
        begin = np.cumsum(sizes) - sizes
        n_win = sizes - length + 1
        win_of = np.repeat(np.arange(len(one)), n_win)
        within = np.arange(int(n_win.sum())) - np.repeat(np.cumsum(n_win) - n_win, n_win)
        rank = ranks(buf, begin[win_of] + within, length)
        total = np.bincount(which, table["n"].to_numpy(), len(one))
        lead = np.full(len(one), len(names))
        np.minimum.at(lead, which, place)
        position = lead[win_of] * (2 * length) + within  # segments of a window differ in place, or else in offset
        earlier, later = previous_factors(rank, position)
        repeats = earlier | later | (total[win_of] > 1)
        stays = ~earlier
        out_repeat, out_first = [], []
        stop = np.cumsum(n_win)
        for i, w in enumerate(which):
            s = slice(stop[w] - n_win[w], stop[w])
            out_repeat.append(np.packbits(repeats[s]).tobytes())
            out_first.append(np.packbits(stays[s] & (place[i] == lead[w])).tobytes())
        return pa.table({"bucket": table["bucket"], "name": table["name"], "repeats": pa.array(out_repeat, pa.binary()),
                         "firsts": pa.array(out_first, pa.binary()), "h": table["h"], "first_id": table["id"],
                         "at": table["at"]})

    told = (sent.join(heavy, "h", "left_anti").withColumn("sort", F.pmod(F.xxhash64("h"), F.lit(n_sorts)))
            .groupBy("sort").applyInArrow(
                judge, f"bucket int, name binary, repeats binary, firsts binary, h bigint, first_id {kind}, at bigint"))
    told = scratch.keep(told.unionByName(_by_digest(sent.join(heavy, "h", "left_semi"), scratch, kind, length)), "told")
    if not keep_first:
        told = told.drop("first_id", "at")

    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, " \
             "starts array<bigint>, ends array<bigint>" + ", kept binary" * with_text

    def finish(block: pa.Table, told: pa.Table) -> pa.Table:
        part = _opened(block) if block.num_rows else None
        answer = dict(zip((x.as_py() for x in told["name"]), range(told.num_rows), strict=True))
        own = np.unique(told["h"].to_numpy().view(np.uint64))
        repeats, firsts = told["repeats"].to_pylist(), told["firsts"].to_pylist()
        lead_id = told["first_id"].to_pylist() if keep_first else None
        lead_at = told["at"].to_pylist() if keep_first else None
        used: set[bytes] = set()
        out = {f: [] for f in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends", "kept")}
        for first, texts in W.slices(part["text"], SLICE) if part is not None else []:
            buf, off = W.raw(texts)
            cover = np.zeros(len(buf) + 1, np.int64)
            for of, lo, raw, _ in _segments(texts, own, length):
                name = xxhash.xxh3_128_digest(raw)
                if (k := answer.get(name)) is None:
                    continue
                n = len(raw) - length + 1
                gone = np.unpackbits(np.frombuffer(repeats[k], np.uint8), count=n).astype(bool)
                if keep_first and name not in used and lo == lead_at[k] and part["id"][first + of].as_py() == lead_id[k]:
                    used.add(name)
                    gone &= ~np.unpackbits(np.frombuffer(firsts[k], np.uint8), count=n).astype(bool)
                at = off[of] + lo + np.flatnonzero(gone)
                cover[at] += 1
                np.subtract.at(cover, at + length, 1)
            gone = np.cumsum(cover)[:-1] > 0
            for i in range(len(texts)):
                mine = gone[off[i]:off[i + 1]]
                edge = np.diff(np.r_[0, mine.astype(np.int8), 0])
                start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                kept = buf[off[i]:off[i + 1]][~mine].tobytes()
                for f, v in (("n_bytes", len(mine)), ("n_removed", int(mine.sum())), ("n_spans", len(start)),
                             ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("starts", start), ("ends", end),
                             ("kept", kept)):
                    out[f].append(v)
        types = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(),
                 "starts": pa.list_(pa.int64()), "ends": pa.list_(pa.int64()), "kept": pa.binary()}
        ids = part["id"].combine_chunks() if part is not None else pa.array([], told["first_id"].type if keep_first else pa.int64())
        cols = {"id": ids} | {f: pa.array(v, types[f]) for f, v in out.items() if f != "kept" or with_text}
        return pa.table(cols)

    done = blocks.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(finish, schema)
    return done.withColumnRenamed("id", id_col)


def op6_repeated_substrings(spark, sf_dir: str) -> DataFrame:
    return marked(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_first=False).drop("starts", "ends")
