"""Cross-tokenizer alignment: the tokens of two vocabularies cut into groups that cover the same bytes.

Divide and conquer at shared cuts. A document is an interval of A tokens and an interval of B tokens
over the same bytes. The A end nearest the middle that is also a B end, found by bisecting the
B ends, cuts the interval; both halves go on alike. An interval without such an end is a leaf: one
group. All open intervals of a slice of documents are worked on together, level by level.

Within a group every A token is linked with every B token. An id pair's count is the number of documents
that hold it linked: each slice sends its distinct pairs once, with their numbers of documents; the counts
come back to the slices that asked, so no row is ever made for a pair of a document.

A null or empty text, and one whose joined token bytes are not the text's, has no tokens: all zeros,
digest ''. Repeated rows count as documents of their own; null ids are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm import words as W
from lakestar.llm.scratch import Scratch
from lakestar.llm.tokens import PIECES, VOCABULARY, Bpe, Coder, Pieces, coder, spread, vocabulary

SLICE = 2 << 20
WIDE = 4096  # links of a group from which its distinct ids are paired instead of its tokens


def align(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups begin, as (A token, B token), in order.

    ends: the tokens' end offsets, ascending. first: where each document's tokens begin (one more for the
    end); both sides of a document end at the same offset, and every document has tokens.
    """
    lo, hi = first_a[:-1].astype(np.int64), first_a[1:].astype(np.int64)
    low, high = first_b[:-1].astype(np.int64), first_b[1:].astype(np.int64)
    begin_a, begin_b = [lo], [low]
    while len(lo):
        # inner ends of an interval: those of its tokens but the last; a side with one token has none
        open_ = (hi - lo > 1) & (high - low > 1)
        lo, hi, low, high = lo[open_], hi[open_], low[open_], high[open_]
        middle = (lo + hi - 2) // 2
        cut_a, cut_b = np.full(len(lo), -1, np.int64), np.full(len(lo), -1, np.int64)
        left = np.arange(len(lo))
        step = 0
        while len(left):
            for way in (0,) if step == 0 else (step, -step):
                at = middle[left] + way
                inside = (at >= lo[left]) & (at < hi[left] - 1) & (cut_a[left] < 0)
                who, at = left[inside], at[inside]
                place = np.searchsorted(ends_b, ends_a[at])  # bisect; the ends of a slice ascend over all its documents
                shared = (place < high[who] - 1) & (ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[at])
                cut_a[who[shared]], cut_b[who[shared]] = at[shared] + 1, place[shared] + 1
            step += 1
            left = left[(cut_a[left] < 0) & ((middle[left] + step < hi[left] - 1) | (middle[left] - step >= lo[left]))]
        cut = cut_a >= 0
        lo, hi, low, high, cut_a, cut_b = (x[cut] for x in (lo, hi, low, high, cut_a, cut_b))
        begin_a.append(cut_a)
        begin_b.append(cut_b)
        lo, hi = np.concatenate([lo, cut_a]), np.concatenate([cut_a, hi])
        low, high = np.concatenate([low, cut_b]), np.concatenate([cut_b, high])
    return np.sort(np.concatenate(begin_a)), np.sort(np.concatenate(begin_b))


@dataclass
class Aligned:
    """The tokens and groups of a slice of documents; documents without tokens have none of either."""
    a: np.ndarray        # ids
    b: np.ndarray
    off_a: np.ndarray    # where each document's tokens begin (one more for the end)
    off_b: np.ndarray
    group_a: np.ndarray  # where each group's tokens begin (one more for the end)
    group_b: np.ndarray
    off_group: np.ndarray  # where each document's groups begin (one more for the end)


def _bytes_of(one: Coder, ids: np.ndarray) -> np.ndarray:
    if not hasattr(one, "table"):
        one.table = (np.frombuffer(b"".join(one.bytes), np.uint8), np.cumsum(one.size) - one.size)
    flat, first = one.table
    return spread(flat, first[ids], one.size[ids])[0]


def _spelled(one: Coder, ids: np.ndarray, off: np.ndarray, buf: np.ndarray, text_off: np.ndarray) -> np.ndarray:
    """Which texts the joined bytes of their tokens spell exactly."""
    size = np.r_[0, np.cumsum(one.size[ids])][off]
    n = np.diff(text_off)
    same = np.diff(size) == n
    held = _bytes_of(one, ids)
    own, first = spread(buf, text_off[:-1][same], n[same])
    theirs, _ = spread(held, size[:-1][same], n[same])
    if len(own):  # every text has a byte at least, the space before it
        same[same] = np.logical_and.reduceat(own == theirs, first[:-1])
    return same


def aligned(texts: pa.LargeStringArray, one: Coder, two: Coder) -> Aligned:
    """Tokens of space + text by both coders, and their groups."""
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
    buf, text_off = W.raw(spaced)
    a, off_a = one.encode(spaced)
    b, off_b = two.encode(spaced)
    good = _spelled(one, a, off_a, buf, text_off) & _spelled(two, b, off_b, buf, text_off) & (np.diff(text_off) > 1)
    n_a, n_b = np.where(good, np.diff(off_a), 0), np.where(good, np.diff(off_b), 0)
    if not good.all():
        a, b = spread(a, off_a[:-1], n_a)[0], spread(b, off_b[:-1], n_b)[0]
        off_a, off_b = np.r_[0, np.cumsum(n_a)], np.r_[0, np.cumsum(n_b)]
    group_a, group_b = align(np.cumsum(one.size[a]), np.cumsum(two.size[b]), np.r_[off_a[:-1][good], len(a)],
                             np.r_[off_b[:-1][good], len(b)])
    return Aligned(a, b, off_a, off_b, np.r_[group_a, len(a)], np.r_[group_b, len(b)], np.searchsorted(group_a, off_a))


def written(x: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """The groups of each document as text, ``a1,a2|b1;a3|b2,b3;``, in one row of bytes, and where each begins."""
    total = len(x.a) + len(x.b)
    ids, mark = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
    n_a, n_b = np.diff(x.group_a), np.diff(x.group_b)
    at_a = np.arange(len(x.a)) + np.repeat(x.group_b[:-1], n_a)
    at_b = np.arange(len(x.b)) + np.repeat(x.group_a[1:], n_b)
    ids[at_a], ids[at_b] = x.a, x.b
    mark[at_a[x.group_a[1:] - 1]] = ord("|")
    mark[at_b[x.group_b[1:] - 1]] = ord(";")
    width = np.ones(total, np.int64)
    top = 10
    while total and (more := ids >= top).any():
        width += more
        top *= 10
    end = np.cumsum(width + 1)
    out = np.empty(int(end[-1]) if total else 0, np.uint8)
    out[end - 1] = mark
    rest, at = ids, end - 2
    while len(at):
        out[at] = rest % 10 + ord("0")
        more = rest >= 10
        rest, at = rest[more] // 10, at[more] - 1
    return out, np.r_[0, end][x.off_a + x.off_b]


def links(x: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, times) of all links; a pair is a * 2**32 + b. The same pair may come several times."""
    n_a, n_b = np.diff(x.group_a), np.diff(x.group_b)
    of = np.repeat(np.arange(len(x.off_group) - 1), np.diff(x.off_group))
    small = n_a * n_b < WIDE
    per = np.repeat(n_b[small], n_a[small])  # each A token meets the group's B tokens in turn
    left, _ = spread(x.a, x.group_a[:-1][small], n_a[small])
    begin = np.repeat(x.group_b[:-1][small], n_a[small])
    right, _ = spread(x.b, begin, per)
    doc = [np.repeat(of[small], (n_a * n_b)[small])]
    pair = [(np.repeat(left, per).astype(np.int64) << 32) | right.astype(np.int64)]
    times = [np.ones(len(pair[0]), np.int64)]
    for g in np.flatnonzero(~small):
        a, many_a = np.unique(x.a[x.group_a[g]:x.group_a[g + 1]], return_counts=True)
        b, many_b = np.unique(x.b[x.group_b[g]:x.group_b[g + 1]], return_counts=True)
        pair.append(((a.astype(np.int64) << 32)[:, None] | b.astype(np.int64)).ravel())
        times.append((many_a[:, None] * many_b).ravel())
        doc.append(np.full(len(pair[-1]), of[g]))
    return np.concatenate(doc), np.concatenate(pair), np.concatenate(times)


def _slice(texts: pa.LargeStringArray, one: Coder, two: Coder) -> dict:
    """What one slice holds: per document its digits; the distinct pairs; per document and pair a place and a number."""
    x = aligned(texts, one, two)
    text, at = written(x)
    raw = memoryview(text)
    sha = [hashlib.sha256(raw[lo:hi - 1]).hexdigest() if hi > lo else "" for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    doc, pair, times = links(x)
    pairs, place = np.unique(pair, return_inverse=True)
    key = doc * max(1, len(pairs)) + place
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, head) if len(head) else times
    doc, place = key[head] // max(1, len(pairs)), key[head] % max(1, len(pairs))
    n = len(texts)
    return {"n_a": np.diff(x.off_a), "n_b": np.diff(x.off_b), "n_groups": np.diff(x.off_group), "sha": sha,
            "pair": pairs, "n_docs": np.bincount(place, minlength=len(pairs)), "first": np.searchsorted(doc, np.arange(n + 1)),
            "place": place.astype(np.int32), "times": times}


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = VOCABULARY, b: str = PIECES) -> DataFrame:
    """One row per slice of documents (see ``_slice``), with the documents' ids."""
    path_a, path_b = vocabulary(a), vocabulary(b)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = coder(Bpe, path_a), coder(Pieces, path_b)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, part in W.slices(batch.column(1), SLICE):
                x = _slice(part, one, two)
                row = {"slice": pa.array([number]), "ids": _list(batch.column(0).slice(first, len(part)))}
                row |= {k: _list(pa.array(x[k], pa.int64())) for k in ("n_a", "n_b", "n_groups", "pair", "n_docs")}
                row["sha"] = _list(pa.array(x["sha"], pa.string()))
                row |= {k: pa.array([x[k].tobytes()], pa.binary()) for k in ("first", "place", "times")}
                number += 1
                yield pa.RecordBatch.from_pydict(row)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"slice bigint, ids array<{kind}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
             "pair array<bigint>, n_docs array<bigint>, sha array<string>, first binary, place binary, times binary")


def _list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pair_counts(asked: DataFrame) -> DataFrame:
    """(pair, count, best) from (pair, n_docs): documents that hold it, and whether its A id has no pair with more.

    An A id has no more pairs than the other vocabulary has ids.
    """
    counts = asked.groupBy("pair").agg(F.sum("n_docs").alias("count"))
    a = F.shiftright("pair", 32).alias("a")
    top = counts.groupBy(a).agg(F.max("count").alias("top"))
    return (counts.select("pair", "count", a).join(top, "a")
            .select("pair", "count", (F.col("count") == F.col("top")).alias("best")))


def per_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = VOCABULARY, b: str = PIECES) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    scratch = Scratch(docs.sparkSession, "alignment")
    kind = docs.schema[id_col].dataType.simpleString()
    slices = scratch.keep(described(docs, id_col, text_col, a, b), "slices")
    asked = slices.select("slice", F.explode(F.arrays_zip("pair", "n_docs")).alias("x")).select("slice", "x.pair", "x.n_docs")
    counts = scratch.keep(pair_counts(asked.select("pair", "n_docs")), "counts")
    told = asked.select(F.col("slice").alias("asker"), "pair").join(counts, "pair")

    def sums(own: pa.Table, told: pa.Table) -> pa.Table:
        ids, sha = own["ids"].chunk(0).flatten(), own["sha"].chunk(0).flatten()
        out = {"id": ids} | {k: own[k].chunk(0).flatten() for k in ("n_a", "n_b", "n_groups")}
        first, place, times = (np.frombuffer(own[k][0].as_py(), t) for k, t in (
            ("first", np.int64), ("place", np.int32), ("times", np.int64)))
        told = told.combine_chunks()
        order = np.argsort(told["pair"].to_numpy())
        count, best = told["count"].to_numpy()[order][place], told["best"].to_numpy()[order][place]

        def per(values: np.ndarray) -> pa.Array:
            return pa.array(np.diff(np.r_[0, np.cumsum(values)][first]), pa.int64())

        out |= {"n_links": per(times), "n_best": per(times * best), "count_sum": per(times * count), "sha": sha}
        return pa.table(out)

    kept = slices.select("slice", "ids", "n_a", "n_b", "n_groups", "sha", "first", "place", "times")
    return (kept.groupBy("slice").cogroup(told.groupBy("asker"))
            .applyInArrow(sums, f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                                "count_sum bigint, sha string")
            .withColumnsRenamed({"id": id_col, "sha": "groups_sha256"}))


def op13_align_tokens(spark, sf_dir: str) -> DataFrame:
    return per_document(spark.read.parquet(f"{sf_dir}/documents.parquet"))
