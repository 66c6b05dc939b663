"""N-gram Jaccard join: T-occurrence search over inverted lists (DivideSkip), linked into groups.

A document's set holds its distinct shingles of five words, as 64-bit hashes. Documents with
equal sets form a class; classes link when 100 * |x & y| >= 80 * |x | y|.

* Inverted lists: each task sends, per bucket of shingle hashes, one posting per distinct
  shingle; further postings of a shingle that the task itself saw twice are known to be
  repeated and travel spread out, so a frequent shingle costs its bucket one posting a task.
* A shingle that only one class holds cannot be in an intersection. A class keeps taking
  part only while ceil(0.8 n) of its shingles are held by others too: exact pruning.
* DivideSkip: a query x needs T = ceil(0.8 n) hits. With its T - 1 longest lists set aside, a
  partner must be in one of the short ones, which are joined by shingle. In
  ``divide_skip`` the short lists of a block of candidates are heap-merged and the long ones are
  probed by binary search.
* ``link_groups`` checks pivots first, then the pairs that are still in different groups, so a
  large group of near copies is neither collected nor expanded into pairs.

Empty texts and texts without words have an empty set and link with nothing. A null text
is empty; a null id is kept and never a group's name unless all its ids are null.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakestar.llm import words as W
from lakestar.llm.components import link_groups
from lakestar.llm.scratch import Scratch, buckets

PERCENT = 80
SHINGLE = 5
FLUSH = 4_000_000      # postings that a task holds before it sends them
PER_BUCKET = 2_000_000  # postings that a bucket is meant for
#: Inverted lists hold 48 bits of a hash. Two sets of 300 shingles then have a wrong hit with a chance of 3e-10; a wrong
#: hit elsewhere only keeps a class in the search for longer.
HASH_BYTES = 6
DROP_BITS = np.uint64(64 - 8 * HASH_BYTES)


def distinct_shingles(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash), distinct, in ascending (hash, text) order."""
    at, run = W.shingles(W.words(texts), SHINGLE)
    order = np.argsort(at, kind="stable") if len(at) > 1 and np.any(at[1:] < at[:-1]) else slice(None)
    at, run = at[order], run[order]
    order = np.argsort(run, kind="stable")
    at, run = at[order], run[order]
    new = np.ones(len(at), bool)
    new[1:] = (run[1:] != run[:-1]) | (at[1:] != at[:-1])
    return at[new], run[new]


def set_digests(at: np.ndarray, run: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Set size and an order-free 64-bit digest of each text's set."""
    n = np.bincount(at, minlength=n_texts)
    order = np.argsort(at, kind="stable")
    total = np.zeros(n_texts, np.uint64)
    if len(at):
        full = np.flatnonzero(n)
        total[full] = np.add.reduceat(W.mix(run[order] + np.uint64(0x51ED270B)), (np.cumsum(n) - n)[full])
    return n, W.mix(total ^ (n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


def sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_shingles, class): one row per document, with ``more`` of its columns."""
    kept = docs.select(F.col(id_col).alias("id"), *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in W.slices(b.column(0)):
                n, digest = set_digests(*distinct_shingles(texts), len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k).slice(first, len(texts)) for k in range(1, b.num_columns)), pa.array(n), pa.array(digest)],
                    [*b.schema.names[1:], "n_shingles", "class"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return (docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"), *more)
            .mapInArrow(run, f"{schema}, n_shingles bigint, class bigint"))


def postings(docs: DataFrame, n_buckets: int, text_col: str = "text") -> DataFrame:
    """(h, class) of every shingle that two or more classes hold."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        names: dict[int, int] = {}
        for b in batches:
            for _, texts in W.slices(b.column(0)):
                at, run = distinct_shingles(texts)
                n, digest = set_digests(at, run, len(texts))
                number = np.full(len(texts), -1)
                for i in np.flatnonzero(n).tolist():
                    if (c := int(digest[i])) not in names:
                        number[i] = names[c] = len(names)
                mine = number[at] >= 0
                held.append((run[mine] >> DROP_BITS, number[at[mine]]))
                size += int(mine.sum())
                if size >= FLUSH:
                    yield from flush(held, names)
                    held, size, names = [], 0, {}
        if size:
            yield from flush(held, names)

    def flush(held: list[tuple[np.ndarray, np.ndarray]], names: dict[int, int]) -> Iterator[pa.RecordBatch]:
        """One row a bucket: its classes, how many postings each has, and the hashes in that order."""
        h, c = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        name = np.fromiter(names, np.int64, len(names))
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        to = (h % np.uint64(n_buckets)).astype(np.int64)
        more = n_buckets + (name.view(np.uint64) % np.uint64(n_buckets)).astype(np.int64)[c]
        to = np.where(first, to, more)
        # a posting whose shingle the task holds twice carries the mark, so its bucket needs no second one
        twice = np.zeros(len(h), bool)
        twice[:-1] = ~first[1:]
        order = np.argsort(to * len(name) + c, kind="stable")
        ends = np.flatnonzero(np.r_[to[order][1:] != to[order][:-1], True]) + 1
        begin = 0
        for end in ends.tolist():
            part = order[begin:end]
            own, n = np.unique(c[part], return_counts=True)
            raw = h[part].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(to[part[0]])]), pa.array([raw.tobytes()], pa.binary()),
                 pa.array([name[own].tobytes()], pa.binary()), pa.array([n.astype("<u4").tobytes()], pa.binary()),
                 pa.array([np.packbits(twice[part]).tobytes()], pa.binary())],
                ["bucket", "h", "names", "sizes", "twice"])
            begin = end

    def repeated(table: pa.Table) -> pa.Table:
        h, c, t = [], [], []
        for row in table.to_batches():
            for i in range(row.num_rows):
                raw = np.frombuffer(row.column(1)[i].as_py(), np.uint8).reshape(-1, HASH_BYTES)
                whole = np.zeros((len(raw), 8), np.uint8)
                whole[:, :HASH_BYTES] = raw
                h.append(whole.view("<u8").ravel())
                c.append(np.repeat(np.frombuffer(row.column(2)[i].as_py(), np.int64),
                                   np.frombuffer(row.column(3)[i].as_py(), "<u4")))
                t.append(np.unpackbits(np.frombuffer(row.column(4)[i].as_py(), np.uint8), count=len(raw)).astype(bool))
        bucket = table.column(0)[0].as_py()
        h, c, t = np.concatenate(h), np.concatenate(c), np.concatenate(t)
        if bucket < n_buckets:
            order = np.lexsort((c, h))
            h, c, t = h[order], c[order], t[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            group = np.cumsum(new) - 1
            start = np.flatnonzero(new)
            last = np.r_[start[1:], len(h)] - 1
            several = (c[last] != c[start]) | (np.bincount(group, t, len(start)) > 0)
            keep = several[group]
            keep[1:] &= ~((h[1:] == h[:-1]) & (c[1:] == c[:-1]))
            h, c = h[keep], c[keep]
        return pa.table({"h": h.view(np.int64), "class": c})

    sent = (docs.select(F.col(text_col).cast("string").alias("text"))
            .mapInArrow(send, "bucket bigint, h binary, names binary, sizes binary, twice binary"))
    return sent.groupBy("bucket").applyInArrow(repeated, "h bigint, class bigint")


def divide_skip(query: np.ndarray, need: int, owner: np.ndarray, tokens: np.ndarray, n_owners: int,
                needs: np.ndarray) -> list[int]:
    """Candidates (numbers below n_owners) that share at least ``needs[candidate]`` tokens with the query.

    query: ascending tokens. owner, tokens: the candidates' postings. ``need`` is the least of ``needs``.
    The need - 1 longest lists are set aside, the others are heap-merged, and the long ones are
    probed by binary search, longest last.
    """
    place = np.searchsorted(query, tokens)
    hit = (place < len(query)) & (query[np.minimum(place, len(query) - 1)] == tokens)
    place, owner = place[hit], owner[hit]
    order = np.lexsort((owner, place))
    place, owner = place[order], owner[order]
    ends = np.flatnonzero(np.r_[place[1:] != place[:-1], True]) + 1 if len(place) else np.zeros(0, int)
    lists, begin = [], 0
    flat = owner.tolist()
    for end in ends.tolist():
        lists.append(flat[begin:end])
        begin = end
    if len(lists) < need:
        return []
    lists.sort(key=len)
    n_long = max(0, need - 1)
    short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
    found: list[int] = []
    merged = heapq.merge(*short)
    current, count = None, 0

    def settle(x: int, n: int) -> None:
        want, left = int(needs[x]), len(long)
        for one in long:
            if n >= want or n + left < want:
                break
            left -= 1
            if one[-1] >= x:
                i = bisect_left(one, x)
                n += one[i] == x
        if n >= want:
            found.append(x)

    for x in merged:
        if x == current:
            count += 1
        else:
            if current is not None and count + n_long >= need:
                settle(current, count)
            current, count = x, 1
    if current is not None and count + n_long >= need:
        settle(current, count)
    return found


def verified(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Of pairs (a, b), those with 100 * |a & b| >= PERCENT * |a | b|. members: class, n, tokens (ascending)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a = b.column("a").to_numpy()
            n_a, n_b = b.column("n_a").to_numpy(), b.column("n_b").to_numpy()
            t_a, t_b = b.column("t_a"), b.column("t_b")
            order = np.argsort(a, kind="stable")
            keep: list[int] = []
            for rows in np.split(order, np.flatnonzero(np.diff(a[order])) + 1) if len(a) else []:
                query = t_a[int(rows[0])].values.to_numpy()
                needs = -(-PERCENT * (n_a[rows] + n_b[rows]) // (100 + PERCENT))
                taken = t_b.take(pa.array(rows))
                tokens = taken.flatten().to_numpy()
                owner = np.repeat(np.arange(len(rows)), np.asarray(taken.value_lengths()))
                keep += [int(rows[i]) for i in divide_skip(
                    query, int(needs.min()), owner, tokens, len(rows), needs)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[keep], pa.int64()), pa.array(b.column("b").to_numpy()[keep], pa.int64())], ["a", "b"])

    left = members.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = members.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "n_b", "t_a", "t_b")
    return joined.mapInArrow(run, "a bigint, b bigint")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_shingles, component_id): one row per document, with ``more`` of its columns; component_id is the smallest linked id."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram")
    info = scratch.keep(sets(docs, id_col, text_col, more), "sets")
    classes = scratch.keep(info.where("n_shingles > 0").groupBy("class").agg(
        F.first("n_shingles").alias("n"), F.min("id").alias("least")), "classes")
    total = info.agg(F.sum("n_shingles")).first()[0] or 0
    lists = scratch.keep(postings(docs, buckets(spark, total, PER_BUCKET), text_col), "lists")
    for turn in range(2):
        # a class that several tasks sent counts twice in the first turn, which only prunes less
        busy = (lists.groupBy("class").agg(F.count("*").alias("held")).join(classes, "class")
                .where(f"100 * held >= {PERCENT} * n").select("class"))
        lists = scratch.keep(lists.join(busy, "class", "left_semi"), "lists")
        lists = lists.distinct() if turn == 0 else lists
        lists = scratch.keep(lists.join(lists.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "h")
                             .select("h", "class"), "lists")
    df = lists.groupBy("h").agg(F.count("*").alias("df"))
    lists = scratch.keep(lists.join(df, "h").join(classes.select("class", "n"), "class"), "lists")
    members = scratch.keep(lists.groupBy("class").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list("h")).alias("tokens")), "members")
    # the n - T + 1 rarest shingles, of which those in one class only are gone already
    rarest = Window.partitionBy("class").orderBy("df", "h")
    entries = scratch.keep(
        lists.withColumn("held", F.count("*").over(Window.partitionBy("class")))
        .withColumn("place", F.row_number().over(rarest) + F.col("n") - F.col("held"))
        .where(f"place <= n - ceil({PERCENT} * n / 100) + 1")
        .select(F.col("h").alias("key"), F.col("class").alias("node"), "n", "held", "place"), "entries")

    def may(a: str, b: str) -> str:
        """At the first shingle that two linked sets share, in order of rarity, both have the overlap still before them."""
        need = f"ceil({PERCENT} * ({a}.n + {b}.n) / {100 + PERCENT})"
        return f"{a}.n - {a}.place + 1 >= {need} and {b}.n - {b}.place + 1 >= {need}"

    comp = link_groups(scratch, entries, lambda p: verified(p, members), may, worth="held / n")
    named = (classes.join(comp, classes["class"] == comp["node"], "left")
             .select("class", "least", F.coalesce("component", "class").alias("component")))
    named = scratch.keep(named, "named")
    groups = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    return (info.join(groups.select("class", "component_id"), "class", "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), *more))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those that are linked, over any path, to one of a smaller id.

    A row is known by its id and its text's hash, so of rows that repeat an id with other texts only
    those go that are linked themselves.
    """
    row = F.xxhash64(F.col(text_col).cast("string"))
    gone = (join(docs.withColumn("__row", row), id_col, text_col, ("__row",)).where(f"component_id <> `{id_col}`")
            .select(F.col(id_col).alias("__gone"), F.col("__row").alias("__gone_row")))
    return docs.join(gone, (F.col(id_col) == F.col("__gone")) & (row == F.col("__gone_row")), "left_anti").select(*docs.columns)


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
