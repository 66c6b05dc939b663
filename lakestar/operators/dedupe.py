"""One row per key under an explicit total order (``DISTINCT ON`` / top-1 per key).

Both forms keep a hot key (say a third of all rows) off a single reducer by
cutting it down before the shuffle:

* ``row_number() == 1`` over ``partitionBy(keys).orderBy(order)``: Catalyst
  plans a *partial* ``WindowGroupLimit`` on the map side, so each map task ships
  at most one row per key;
* with ``extra_aggs`` (other per-key aggregates in the same shuffle) the pick is
  ``min(struct(order fields..., payload...))``, a partial + final aggregate.
  Within the struct NULL sorts first, so each order field carries a null flag.

Appending every payload column after the stated order makes the pick a total
order, so reruns and task retries choose the same row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Order:
    column: str
    descending: bool = False
    nulls_first: bool = False

    def sql(self) -> str:
        return f"{self.column} {'DESC' if self.descending else 'ASC'} NULLS {'FIRST' if self.nulls_first else 'LAST'}"


def asc(c: str, nulls_first: bool = False) -> Order:
    return Order(c, False, nulls_first)


def desc(c: str, nulls_first: bool = False) -> Order:
    return Order(c, True, nulls_first)


def _descending_value(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return -c.cast("long")
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return -c
    if isinstance(dt, T.DateType):
        return -F.unix_date(c)
    if isinstance(dt, T.BooleanType):
        return ~c
    raise TypeError(f"descending order on {dt.simpleString()} is not supported")


def _order_fields(df: DataFrame, orders: list[Order]) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for i, o in enumerate(orders):
        c = F.col(o.column)
        # the flag sorts first inside the struct: false < true
        flag = c.isNotNull() if o.nulls_first else c.isNull()
        value = _descending_value(c, types[o.column]) if o.descending else c
        fields += [flag.alias(f"__o{i}n"), value.alias(f"__o{i}v")]
    return fields


def _sort_col(o: Order) -> Column:
    c = F.col(o.column)
    if o.descending:
        return c.desc_nulls_first() if o.nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if o.nulls_first else c.asc_nulls_last()


def first_per_key(df: DataFrame, keys: list[str], orders: list[Order] | None = None,
                  extra_aggs: list[Column] | None = None) -> DataFrame:
    """Keep the first row per ``keys`` by ``orders`` then all remaining columns ascending.

    ``extra_aggs`` are computed in the same aggregation (same shuffle), e.g. a
    ``min`` over the whole group next to the pick.
    """
    orders = orders or []
    payload = [c for c in df.columns if c not in keys]
    if not extra_aggs:
        w = Window.partitionBy(*keys).orderBy(*[_sort_col(o) for o in orders],
                                              *[F.col(c).asc_nulls_first() for c in payload])
        return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
    pick = F.struct(*_order_fields(df, orders), *[F.col(c) for c in payload])
    aggs = [F.min(pick).alias("__first")] + list(extra_aggs or [])
    out = df.groupBy(*keys).agg(*aggs)
    extra_names = [c for c in out.columns if c not in keys and c != "__first"]
    return out.select(*[F.col(k) for k in keys], *[F.col("__first")[c].alias(c) for c in payload],
                      *[F.col(c) for c in extra_names]).select(*df.columns, *extra_names)
