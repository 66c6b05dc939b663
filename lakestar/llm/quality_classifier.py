"""Quality classifier: regularised quadratic discriminant over document statistics.

The statistics of every document are counted in one pass over its bytes and word hashes and
transformed (logarithms of counts and rates). Per class, Spark sums n, sum(x) and sum(x x') of all
labelled training rows; the driver sees only those sums (a few hundred numbers, whatever the
input). Each class covariance is shrunk towards the pooled one and that towards its diagonal.
A score is the logistic of the difference of the class log densities, each a Mahalanobis
distance through the class's Cholesky factor, which is inverted once and kept in the model.

Null texts are empty; an empty text has all-zero statistics and gets a score as any other.
Rows with a null id, a null label, or a label that is neither 0 nor 1 do not train. Repeated
labels each count. With labels of one class only the score is that class; without labels 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm import words as W
from lakestar.llm.scratch import Scratch, reachable

CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "bang": b"!?",
    "symbol": b"#*$%&|<>",
    "stop": b".,;:",
    "newline": b"\n",
    "space": b" \t\r\x0b\x0c",
    "lead": bytes(range(0xC0, 0x100)),
    "tail": bytes(range(0x80, 0xC0)),
}
_KIND = np.full(256, len(CLASSES))
for _i, _c in enumerate(CLASSES.values()):
    _KIND[list(_c)] = _i
RATES = ("upper", "digit", "bang", "symbol", "stop", "newline", "lead")
NAMES = ("log_words", "log_word_chars", *(f"log_{c}" for c in RATES), "log_other", "distinct", "log_top",
         "log_same_as_last", "log_short", "distinct_pairs")
#: Rates are those of the text together with so much text of these rates, so that a few words do not look extreme.
PRIOR_CHARS, PRIOR_WORDS = 200, 40
PRIOR = {"upper": 0.02, "digit": 0.002, "bang": 0.001, "symbol": 0.001, "stop": 0.025, "newline": 0.005, "lead": 0.02,
         "other": 0.002, "same": 0.002, "short": 0.4, "top": 0.05}
SHRINK = 0.2  # of a class covariance towards the pooled one
DIAGONAL = 0.1  # of the pooled covariance towards its diagonal
THRESHOLD = 0.3
SLICE = 1 << 20  # bytes of text worked on at a time: the arrays over its bytes take some 40 times as much


def _runs(of: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of h in each text, and how often the most frequent one occurs."""
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, of[first], np.diff(np.r_[first, len(h)]))
    return np.bincount(of[first], minlength=n), top


def statistics(texts: pa.LargeStringArray) -> np.ndarray:
    """One row of transformed statistics (NAMES) for each text."""
    n = len(texts)
    w = W.words(texts)
    of_byte = np.repeat(np.arange(n), np.diff(w.text_off))
    k = len(CLASSES) + 1
    kinds = np.bincount(of_byte * k + _KIND[w.buf], minlength=n * k).reshape(n, k).astype(float)
    got = dict(zip(CLASSES, kinds.T, strict=False))
    chars = np.maximum(kinds.sum(1) - got["tail"], 1)
    h, of, n_words = w.hashes(cased=True), w.text_of(), w.counts().astype(float)
    some = np.maximum(n_words, 1)
    distinct, top = _runs(of, h, n)
    pair = W.mix(h[:-1] * np.uint64(31) + h[1:])
    inside = of[1:] == of[:-1]
    pairs, _ = _runs(of[:-1][inside], pair[inside], n)
    same = np.bincount(of[:-1][inside & (h[1:] == h[:-1])], minlength=n)
    short = np.bincount(of[(w.end - w.start) <= 3], minlength=n)
    solid = chars - got["space"] - got["newline"]

    def rate(x: np.ndarray, of: np.ndarray, more: int, name: str) -> np.ndarray:
        return np.log((x + more * PRIOR[name]) / (of + more))

    cols = [np.log1p(n_words), np.log((solid + 5 * PRIOR_WORDS) / (some + PRIOR_WORDS))]
    cols += [rate(got[c], chars, PRIOR_CHARS, c) for c in RATES]
    cols += [rate(kinds[:, -1], chars, PRIOR_CHARS, "other"), np.log((distinct + PRIOR_WORDS) / (some + PRIOR_WORDS)),
             rate(top, some, PRIOR_WORDS, "top"), rate(same, some, PRIOR_WORDS, "same"),
             rate(short, some, PRIOR_WORDS, "short"), np.log((pairs + PRIOR_WORDS) / (some + PRIOR_WORDS))]
    x = np.column_stack(cols)
    x[n_words == 0] = 0
    return x


@dataclass
class Model:
    mean: np.ndarray       # class x statistic
    whiten: np.ndarray     # class: inverse of the covariance's Cholesky factor
    offset: np.ndarray     # class: log prior - half the log determinant
    only: float | None = None  # the score if fewer than two classes were seen

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(x), self.only)
        log = [o - 0.5 * np.square((x - m) @ a.T).sum(1)
               for m, a, o in zip(self.mean, self.whiten, self.offset, strict=True)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def fit(rows: DataFrame, shrink: float = SHRINK, diagonal: float = DIAGONAL) -> Model:
    """Fit on rows (label 0 or 1, x array<double>)."""
    d = len(NAMES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, d + 1, d + 1))
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, d)
            x = np.column_stack([np.ones(len(x)), x])
            label = b.column(0).to_numpy()
            for c in (0, 1):
                total[c] += x[label == c].T @ x[label == c]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "v"])

    got = (rows.select(F.col("label").cast("int"), "x").mapInArrow(sums, "at bigint, v double")
           .groupBy("at").agg(F.sum("v").alias("v")).collect())
    total = np.zeros((2, d + 1, d + 1))
    for r in got:
        total.flat[r["at"]] = r["v"]
    n = total[:, 0, 0]
    if (n < 1).any():
        return Model(*[np.zeros(0)] * 3, only=0.5 if (n < 1).all() else float(n[1] > 0))
    mean = total[:, 0, 1:] / n[:, None]
    scatter = np.stack([total[c, 1:, 1:] - n[c] * np.outer(mean[c], mean[c]) for c in (0, 1)])
    pooled = scatter.sum(0) / n.sum()
    spread = np.maximum(np.diag(pooled), 1e-6)
    pooled = (1 - diagonal) * pooled + diagonal * np.diag(spread)
    whiten, offset = [], []
    for c in (0, 1):
        factor = np.linalg.cholesky((1 - shrink) * scatter[c] / n[c] + shrink * pooled)
        whiten.append(np.linalg.inv(factor))
        offset.append(np.log(n[c] / n.sum()) - np.log(np.diag(factor)).sum())
    return Model(mean, np.stack(whiten), np.array(offset))


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    reachable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in W.slices(b.column(1), SLICE):
                x = statistics(texts)
                at = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(x)), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], ["id", "x"])
            W.give_back()

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, x array<double>"))


def held_out(key: Column, folds: int) -> Column:
    """Whether crc32 of the key as text leaves no remainder; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(described_docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model:
    """Fit on the labelled documents outside the held-out fold. labels: doc_id, quality."""
    told = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return fit(described_docs.where(~held_out(F.col("id"), folds)).join(told, "id").select("label", "x"))


def scored(described_docs: DataFrame, model: Model) -> DataFrame:
    """(id, score): the statistics' scores."""
    kind = described_docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], ["id", "score"])

    return described_docs.select("id", "x").mapInArrow(run, f"id {kind}, score double")


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least the threshold, with all their columns; no shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in W.slices(b.column(at), SLICE):
                keep = model.score(statistics(texts)) >= threshold
                yield b.slice(first, len(texts)).filter(pa.array(keep))
            W.give_back()

    return docs.mapInArrow(run, docs.schema)


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    x = Scratch(spark, "quality").keep(described(docs), "statistics")
    model = train(x, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(x, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id"), 5).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
