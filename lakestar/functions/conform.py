"""Assignment-cast a frame onto a target StructType (the INSERT ... SELECT cast)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns beside a raw table's own: a malformed line, reasons of lost values, the row's texts.
LINE, LOST, LANDED = "__line", "__lost", "__landed"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def cast_to(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast the way a database assigns a value to a typed column.

    Fractional -> integral rounds half to even (``rint``), where a plain cast
    would truncate; text goes through a double first. Failures become NULL
    (``try_cast``) and are reported by the quality checks.
    """
    if source == target:
        return c
    if isinstance(target, _INTEGRAL):
        if isinstance(source, _FRACTIONAL):
            return F.rint(c.cast("double")).try_cast(target)
        if isinstance(source, T.StringType):
            # whole numbers as they are (a double has 53 bits only), others through a double
            return F.coalesce(F.trim(c).try_cast(target), F.rint(F.trim(c).try_cast("double")).try_cast(target))
    return c.try_cast(target)


def as_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every column as text (absent ones NULL): the form in which raw tables are landed. Malformed lines are kept."""
    names = [*columns, *[c for c in df.columns if c == LINE]] if columns else df.columns
    return df.select(*[(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
                       for c in names])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to the contract's types; columns that have a type already are left as they are."""
    want = {f.name: f.dataType for f in schema.fields}
    return df.select(*[
        cast_to(F.col(f.name), f.dataType, want[f.name]).alias(f.name)
        if isinstance(f.dataType, T.StringType) and f.name in want else F.col(f.name) for f in df.schema.fields])


def failed_casts(df: DataFrame, schema: T.StructType) -> list[tuple[str, T.DataType, Column]]:
    """(column, wanted type, whether a text that is there is lost by the cast) of a landed table."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [(f.name, f.dataType, F.col(f.name).isNotNull() & cast_to(F.col(f.name), have[f.name], f.dataType).isNull())
            for f in schema.fields if isinstance(have.get(f.name), T.StringType)
            and not isinstance(f.dataType, T.StringType)]


def flagged(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``typed`` rows of a landed table, and beside them what was lost: ``__lost`` holds the reasons (NULL when all
    texts fit), ``__landed`` the row's texts as JSON, ``__line`` a malformed line that holds no row at all.

    A frame whose columns have types already has nothing to lose and gets no such columns.
    """
    lost = [F.when(cond, F.lit(f"{c} is not a valid {kind.simpleString()}")) for c, kind, cond in failed_casts(df, schema)]
    out = [x for x in typed(df, schema).columns if x != LINE]
    values = typed(df, schema)
    if not lost and LINE not in df.columns:
        return values
    why = F.filter(F.array(*lost), lambda x: x.isNotNull()) if lost else F.array().cast("array<string>")
    image = F.to_json(F.struct(*[F.col(c) for c in out]))
    have = df.select("*", why.alias(LOST), image.alias(LANDED))
    kept = F.size(LOST) > 0
    cols = [F.col(LINE) if LINE in df.columns else F.lit(None).cast("string").alias(LINE),
            F.when(kept, F.col(LOST)).alias(LOST), F.when(kept, F.col(LANDED)).alias(LANDED)]
    return typed(have, schema).select(*out, *cols)


def well_formed(df: DataFrame) -> DataFrame:
    """The rows of a flagged table, without its flags."""
    rows = df.where(F.col(LINE).isNull()) if LINE in df.columns else df
    return rows.drop(LINE, LOST, LANDED)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types; absent columns are NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(cast_to(F.col(f.name), have[f.name], f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
