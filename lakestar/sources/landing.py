"""Raw (bronze) landing: every value as the text that was read, columns matched to the
contract by name, rows that are entirely NULL dropped. Types come later, in the silver build, where a
text that does not fit its type becomes a reject record, as does a malformed line. A missing table is
reported and skipped.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar import schemas
from lakestar.functions.conform import LINE, as_text

log = logging.getLogger(__name__)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files as text, by the header's names, with ``__line`` holding each malformed line.

    A line with too few or too many cells, or with a quoted cell that does not end where a cell should, is
    kept whole in ``__line`` and gives no values. The first file's header names the columns; a file
    with other headers is an error, since its cells would land in the wrong columns.
    """
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"',
               "unescapedQuoteHandling": "STOP_AT_CLOSING_QUOTE"}
    names = spark.read.options(**options, inferSchema=False).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, LINE]])
    df = spark.read.schema(schema).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE,
                                           enforceSchema=False).csv(path)
    # values of a malformed line may have moved to other columns
    return df.select(*[F.when(F.col(LINE).isNull(), F.col(c)).alias(c) for c in names], LINE)


def read_raw_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame | None:
    """Read one raw table, all columns as text; ``None`` if the path does not exist."""
    try:
        if fmt == "csv":
            df = read_csv(spark, path)
        else:
            df = spark.read.format(fmt).load(path)
        df.schema  # resolves the path now, so a missing table is caught here
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            log.warning("raw table %s not found at %s; skipped", table, path)
            return None
        raise
    return as_text(df, schemas.RAW[table].names)


def land(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is NULL."""
    return df.na.drop(how="all")


def read_raw_set(spark: SparkSession, folder: str, fmt: str = "parquet",
                 tables: list[str] | None = None, domain: str = "subscriptions") -> dict[str, DataFrame]:
    """``{table: landed frame}`` for every raw table present under ``folder``.

    ``domain="ticketing"`` reads the documented ticketing inputs (artists, venues,
    events, customers, tickets, checkins, refunds, campaigns) instead.
    """
    ext = {"csv": ".csv", "parquet": ""}.get(fmt, "")
    prefix = "ticketing." if domain == "ticketing" else ""
    names = tables or (list(schemas.RAW_TICKETING) if domain == "ticketing" else schemas.RAW_TABLES)
    out = {}
    for t in names:
        df = read_raw_table(spark, f"{folder.rstrip('/')}/{t}{ext}", prefix + t, fmt)
        if df is not None:
            out[t] = land(df)
    return out
