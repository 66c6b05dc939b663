"""Best-two-fit packing of documents into sequences of a fixed length.

A document's ids and its end id are cut, if longer than a sequence, into whole sequences from
its end, so the first piece may be shorter. Whole pieces are sequences of their own. The others
are dealt to packers by a hash of the document; each packer fills sequences greedily, longest
fitting piece first, then puts two unpacked pieces in place of a sequence's smallest one if
they fit the widened gap more tightly. A packer closes all but its last sequence as tightly as
the method can, so the number of packers (one for every ``PER_PACKER`` pieces) costs at
most about one sequence each.

Packers see lengths alone; the placed pieces are joined back to their ids by row. A null text is
empty (its piece holds the end id alone); repeated rows are packed once each; null ids are kept.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.scratch import Scratch
from lakestar.llm.tokens import VOCABULARY, encoded, vocabulary

LENGTH = 2048
END = 0
PER_PACKER = 20_000


def pieces(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary_name: str = VOCABULARY,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the pieces of every document."""
    path = vocabulary(vocabulary_name)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, n, ids, off in encoded(b.column(1), path):
                ids = np.insert(ids, off[1:], end).astype("<u4", copy=False)
                of, piece, start, size = cuts(np.diff(off) + 1, length)
                at = np.r_[0, np.cumsum(size)]
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                cols = [b.column(0).take(pa.array(first + of)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size),
                        pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, schema + ", ids array<int>" * with_ids))


def cuts(n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, size) of the pieces of documents of n ids each; only a first piece may be shorter."""
    pieces = -(-n // length)
    of = np.repeat(np.arange(len(n)), pieces)
    piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    head = (n - (pieces - 1) * length)[of]
    start = np.where(piece > 0, head + (piece - 1) * length, 0)
    return of, piece, start, np.where(piece > 0, length, head)


def best_two_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; no piece is longer than ``size``."""
    order = np.argsort(-lengths, kind="stable").tolist()
    of_length: dict[int, list[int]] = {}
    for i in order:
        of_length.setdefault(int(lengths[i]), []).append(i)
    held = sorted(of_length)  # lengths that still have pieces, ascending; at most ``size`` of them
    bins: list[list[int]] = []

    def take(n: int) -> int:
        one = of_length[n].pop()
        if not of_length[n]:
            del of_length[n]
            held.pop(bisect_right(held, n) - 1)
        return one

    def give(i: int) -> None:
        n = int(lengths[i])
        if n not in of_length:
            of_length[n] = []
            held.insert(bisect_right(held, n), n)
        of_length[n].append(i)

    def two_within(room: int, over: int) -> tuple[int, int] | None:
        """The two held lengths whose sum is nearest to room, above ``over``: two ends moving inwards."""
        best, found = over, None
        lo, hi = 0, bisect_right(held, room) - 1
        while lo <= hi:
            a, b = held[lo], held[hi]
            if a + b > room:
                hi -= 1
                continue
            if a + b > best and (lo != hi or len(of_length[a]) > 1):
                best, found = a + b, (a, b)
                if best == room:
                    break
            lo += 1
        return found

    while held:
        one: list[int] = []
        gap = size
        while held:
            fit = bisect_right(held, gap) - 1
            if fit < 0:
                break
            gap -= held[fit]
            one.append(take(held[fit]))
        if gap and held and len(one) > 1:
            least = one[-1]  # the greedy fill takes pieces in falling order
            n = int(lengths[least])
            if found := two_within(gap + n, n):
                one.pop()
                one += [take(found[1]), take(found[0])]
                give(least)
        bins.append(one)
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, one in enumerate(bins):
        at = 0
        for i in one:
            place[i], offset[i] = k, at
            at += int(lengths[i])
    return place, offset


def pack(spark, found: DataFrame, length: int = LENGTH, per_packer: int = PER_PACKER) -> DataFrame:
    """Add sequence_id and offset to pieces (id, piece, start, length, ...)."""
    packers = max(1, -(-found.where(F.col("length") < length).count() // per_packer))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([(c, "ascending") for c in ("start", "ids_crc32", "id", "piece")])
        n = table["length"].to_numpy()
        place, offset = best_two_fit(n, length)
        packer = table["packer"].to_numpy()
        table = table.drop_columns(["packer"])
        return table.append_column("sequence_id", pa.array((packer + 1) * 2**33 + place)).append_column(
            "offset", pa.array(offset))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    short = (found.where(F.col("length") < length)
             .withColumn("packer", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(packers)))
             .groupBy("packer").applyInArrow(run, f"{schema}, sequence_id bigint, offset bigint"))
    whole = found.where(F.col("length") >= length).withColumn(
        "sequence_id", F.monotonically_increasing_id() * -1 - 1).withColumn("offset", F.lit(0).cast("bigint"))
    return short.unionByName(whole)


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
           end: int = END, vocabulary_name: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): every piece and its place."""
    scratch = Scratch(docs.sparkSession, "packing")
    found = pieces(docs, length, end, vocabulary_name, id_col, text_col, with_ids)
    if not with_ids:
        return pack(docs.sparkSession, scratch.keep(found, "pieces"), length).withColumnRenamed("id", id_col)
    found = scratch.keep(found.withColumn("row", F.monotonically_increasing_id()), "pieces")
    placed = pack(docs.sparkSession, found.drop("ids"), length)
    return (placed.join(found.select("row", "ids"), "row").drop("row").withColumnRenamed("id", id_col))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of each sequence in a row, from ``packed`` with ids."""
    return placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"))


def digested(placed: DataFrame) -> DataFrame:
    """Placed pieces with ids_crc32 taken from the ids as placed, without the ids."""
    kept = [c for c in placed.columns if c != "ids"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.select(kept).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            at = np.r_[0, np.cumsum(ids.value_lengths().to_numpy())].tolist()
            raw = memoryview(ids.flatten().to_numpy()).cast("B")  # the batch's own buffer, not a copy
            crc = pa.array([zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(at[:-1], at[1:], strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([crc if c == "ids_crc32" else b.column(c) for c in kept], kept)

    return placed.mapInArrow(run, schema)


def op9_best_two_fit(spark, sf_dir: str) -> DataFrame:
    return digested(packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=True))
