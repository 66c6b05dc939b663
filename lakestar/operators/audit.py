"""Load audit: row counts observed on the write and a content fingerprint that any engine can work out.

A row is written as text, column by column in order: ``N`` for NULL, else ``V``, the number of characters,
``:`` and the value (fractions with six decimals, timestamps with microseconds, everything else as its plain
text). The fingerprint is a SHA-256 over the row count and two sums of parts of the rows' MD5 digests, so
neither row order nor partitioning matters.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 15     # hexadecimal digits of a digest part: 60 bits


def canonical(c: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        value = F.coalesce(F.col(c).try_cast("decimal(28,6)").cast("string"), F.col(c).cast("string"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    else:
        value = F.col(c).cast("string")
    return F.when(F.col(c).isNull(), "N").otherwise(F.concat(F.lit("V"), F.char_length(value).cast("string"), F.lit(":"), value))


def row_digest(df: DataFrame) -> Column:
    """MD5, in hexadecimal, of a row's canonical text."""
    return F.md5(F.concat(F.lit(""), *[canonical(f.name, f.dataType) for f in df.schema.fields]))


def fingerprint_metrics(df: DataFrame) -> list[Column]:
    """Aggregates for ``DataFrame.observe``: the fingerprint taken during a write, no second pass."""
    part = lambda at: F.conv(F.substring(row_digest(df), at, DIGITS), 16, 10).cast("decimal(38,0)")
    none = F.lit(0).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(part(1)), none).alias("hash_high"),
            F.coalesce(F.sum(part(1 + DIGITS)), none).alias("hash_low")]


def fingerprint_from_metrics(m: dict) -> str:
    """Same value as :func:`fingerprint` computes in Spark."""
    text = f"{int(m['row_count'])}|{int(m['hash_high'])}|{int(m['hash_low'])}"
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``row_count`` and the fingerprint. One pass; partial aggregates per task, no shuffle of rows."""
    agg = df.agg(*fingerprint_metrics(df))
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("row_count", "hash_high", "hash_low")])
    return agg.select("row_count", F.sha2(text, 256).alias("fingerprint"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, rows)`` for several tables in one job (a union of global counts)."""
    frames = [df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
              for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
