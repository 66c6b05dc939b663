"""Dense, repeatable surrogate ids (``SERIAL`` re-expressed) without a global window.

``row_number() over (order by name)`` with no partition moves every row to one
task. Here the distinct values are range-partitioned and sorted, each partition
numbers its rows locally (``monotonically_increasing_id`` keeps the partition
index in the upper bits and the row position in the lower 33), and a table of
per-partition counts -- one row per partition, so its size is bounded by the
partition count, not by the data -- turns local positions into global ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.operators.joins import materialize

_LOW_BITS = (1 << 33) - 1


def dense_ids(df: DataFrame, order_col: str, id_col: str, id_type: str = "int",
              group_col: str | None = None) -> DataFrame:
    """Number the distinct values of ``order_col`` 1..n by ascending value, in each group if one is named.

    ``df`` must already hold one row per (group and) value. The position id is computed once
    and written (``materialize``), so the counts and the numbering read the same
    values even if tasks are retried or files are read back in another order.
    """
    group = F.col(group_col) if group_col else F.lit(0)
    order = [group.asc_nulls_first(), F.col(order_col).asc_nulls_first()] if group_col else [
        F.col(order_col).asc_nulls_first()]
    ranged = (df.repartitionByRange(*order)
              .sortWithinPartitions(*order)
              .withColumn("__mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged)
    part = F.shiftright(F.col("__mid"), 33)
    place = F.col("__mid").bitwiseAND(F.lit(_LOW_BITS))
    # one row per partition and group in it: ranges are sorted, so at most partitions + groups rows
    counts = ranged.groupBy(part.alias("__part"), group.alias("__group")).agg(
        F.count(F.lit(1)).alias("__n"), F.min(place).alias("__first"))
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", "__group", "__first",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    numbered = ranged.join(F.broadcast(offsets), (part == F.col("__part")) & group.eqNullSafe(F.col("__group")))
    new_id = (F.col("__offset") + place - F.col("__first") + 1).cast(id_type)
    return numbered.select(new_id.alias(id_col), *[F.col(c) for c in df.columns])
