"""Constraint checks that the reference left to the database (PK, UNIQUE, NOT NULL, FK,
VARCHAR(n), NUMERIC(p,s)).

Row-wise findings (nulls, lengths, precision) are counted while a table is written
(``column_metrics``), so no table is read again for them. All key sets of a table come from one scan
(grouping sets), and all relations of a parent from one shuffle (a tagged union of keys).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.schemas import Table

DQ_COLUMNS = ["check_name", "table_name", "column_name", "violations"]


def _unpivot(row: DataFrame, pairs: list[tuple[str, Column]], name_col: str, value_col: str) -> DataFrame:
    """Turn one wide aggregate row into (name, value) rows."""
    arr = F.array(*[F.struct(F.lit(n).alias("n"), v.cast("long").alias("v")) for n, v in pairs])
    return row.select(F.explode(arr).alias("kv")).select(F.col("kv.n").alias(name_col), F.col("kv.v").alias(value_col))


def key_summary(df: DataFrame, table_name: str, key_cols: list[str]) -> DataFrame:
    """Rows, rows with a NULL key part, and key values held by more than one row."""
    g = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("__n"))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key_cols])
    return g.agg(F.lit(table_name).alias("table_name"), F.lit(",".join(key_cols)).alias("key_columns"),
                 F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("total_rows"),
                 F.coalesce(F.sum(F.when(any_null, F.col("__n"))), F.lit(0)).cast("long").alias("null_key_rows"),
                 F.count(F.when(~any_null & (F.col("__n") > 1), F.lit(1))).cast("long")
                 .alias("duplicate_key_values"))


def key_summaries(df: DataFrame, table_name: str, key_sets: list[list[str]]) -> DataFrame:
    """``key_summary`` for several key sets of a table from one scan and one shuffle (grouping sets)."""
    if len(key_sets) == 1:
        return key_summary(df, table_name, key_sets[0])
    cols = list(dict.fromkeys(c for keys in key_sets for c in keys))
    g = df.groupingSets([[F.col(c) for c in keys] for keys in key_sets], *cols).agg(
        F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set"))
    aggs, found = [], []
    for i, keys in enumerate(key_sets):
        # a grouping id has one bit a column, set where the column is not part of the grouping
        mine = F.col("__set") == sum(1 << (len(cols) - 1 - k) for k, c in enumerate(cols) if c not in keys)
        any_null = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
        aggs += [F.sum(F.when(mine, F.col("__n"))).alias(f"rows{i}"),
                 F.sum(F.when(mine & any_null, F.col("__n"))).alias(f"nulls{i}"),
                 F.count(F.when(mine & ~any_null & (F.col("__n") > 1), F.lit(1))).alias(f"dups{i}")]
        value = lambda n, k=i: F.coalesce(F.col(f"{n}{k}"), F.lit(0)).cast("long")
        found.append(F.struct(F.lit(",".join(keys)).alias("key_columns"), value("rows").alias("total_rows"),
                              value("nulls").alias("null_key_rows"), value("dups").alias("duplicate_key_values")))
    return g.agg(*aggs).select(F.explode(F.array(*found)).alias("x")).select(
        F.lit(table_name).alias("table_name"), "x.*")


def precision_summary(df: DataFrame, table_name: str, cols: dict[str, tuple[int, int]]) -> DataFrame:
    """Values present in the source that do not fit NUMERIC(p, s)."""
    names = list(cols)
    row = df.agg(*[F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull(),
                                  F.lit(1))).alias(c) for c, (p, s) in cols.items()])
    out = _unpivot(row, [(c, F.col(c)) for c in names], "column_name", "overflow_rows")
    return out.select(F.lit(table_name).alias("table_name"), "column_name", "overflow_rows")


def orphan_summary(child: DataFrame, col: str, parent: DataFrame, parent_col: str, table_name: str,
                   parent_name: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (left anti join)."""
    keys = parent.select(F.col(parent_col).alias(col))
    orphans = child.select(col).where(F.col(col).isNotNull()).join(keys, col, "left_anti")
    return orphans.agg(F.count(F.lit(1)).cast("long").alias("orphan_rows")).select(
        F.lit(table_name).alias("table_name"), F.lit(col).alias("column_name"),
        F.lit(parent_name).alias("parent_table"), "orphan_rows")


def orphan_summaries(relations: list[tuple[DataFrame, str, str]], parent: DataFrame, parent_col: str,
                     parent_name: str) -> DataFrame:
    """``orphan_summary`` for all relations of a parent, (child, column, child's name), in one shuffle.

    Keys of the parent and of all children are counted side by side, map-side first, so a hot key sends
    one row a task; keys that the parent lacks give each relation's orphans.
    """
    parts = [parent.select(F.col(parent_col).alias("key"), F.lit(-1).alias("rel"))]
    parts += [child.select(F.col(col).alias("key"), F.lit(i).alias("rel")) for i, (child, col, _) in enumerate(relations)]
    count = lambda i: F.count(F.when(F.col("rel") == i, F.lit(1))).alias(f"n{i}")
    keys = reduce(lambda a, b: a.union(b), parts).where(F.col("key").isNotNull())
    per_key = keys.groupBy("key").agg(count(-1).alias("known"), *[count(i) for i in range(len(relations))])
    row = per_key.where(F.col("known") == 0).agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(relations))])
    found = [F.struct(F.lit(name).alias("table_name"), F.lit(col).alias("column_name"),
                      F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("long").alias("orphan_rows"))
             for i, (_, col, name) in enumerate(relations)]
    return row.select(F.explode(F.array(*found)).alias("x")).select(
        "x.table_name", "x.column_name", F.lit(parent_name).alias("parent_table"), "x.orphan_rows")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def column_checks(df: DataFrame, table_name: str, not_null: list[str],
                  limits: dict[str, int]) -> tuple[DataFrame | None, DataFrame | None]:
    """NOT NULL and VARCHAR(n) findings from ONE aggregate pass over the table."""
    aggs = [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"nn__{c}") for c in not_null]
    aggs += [F.count(F.when(F.char_length(c) > n, F.lit(1))).alias(f"vc__{c}") for c, n in limits.items()]
    if not aggs:
        return None, None
    row = df.agg(*aggs)
    nn = vc = None
    if not_null:
        arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"nn__{c}").cast("long").alias("null_rows"))
                        for c in not_null])
        nn = row.select(F.explode(arr).alias("kv")).select(F.lit(table_name).alias("table_name"),
                                                          "kv.column_name", "kv.null_rows")
    if limits:
        arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_chars"),
                                 F.col(f"vc__{c}").cast("long").alias("overflow_rows")) for c, n in limits.items()])
        vc = row.select(F.explode(arr).alias("kv")).select(F.lit(table_name).alias("table_name"), "kv.column_name",
                                                          "kv.max_chars", "kv.overflow_rows")
    return nn, vc


def column_metrics(t: Table, varchar: bool = True, rows: Column | None = None) -> list[Column]:
    """NOT NULL and VARCHAR(n) counts of a contract, to be observed while its table is written.

    ``rows``: which of the written rows count.
    """
    held = F.lit(True) if rows is None else rows
    out = [F.count(F.when(held & F.col(c).isNull(), F.lit(1))).alias(f"nn__{c}") for c in t.not_null]
    if varchar:
        out += [F.count(F.when(held & (F.char_length(c) > n), F.lit(1))).alias(f"vc__{c}") for c, n in t.varchar.items()]
    return out


def precision_metrics(df: DataFrame, t: Table) -> list[Column]:
    """Values of a raw table that do not fit the NUMERIC(p,s) of its silver contract, observed while it is written."""
    kinds = {c: t.schema[c].dataType for c in t.numeric if c in df.columns}
    return [F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(k).isNull(), F.lit(1))).alias(f"np__{c}")
            for c, k in kinds.items()]


def observed_checks(spark: SparkSession, found: list[tuple[str, Table, dict]]) -> dict[str, DataFrame]:
    """Not-null and length findings from observed metrics, (qualified name, contract, metrics); one row a contract column."""
    nulls = [(name, c, int(m[f"nn__{c}"])) for name, t, m in found for c in t.not_null if f"nn__{c}" in m]
    long = [(name, c, n, int(m[f"vc__{c}"])) for name, t, m in found for c, n in t.varchar.items() if f"vc__{c}" in m]
    return {"not_null": spark.createDataFrame(nulls, "table_name string, column_name string, null_rows long"),
            "varchar": spark.createDataFrame(long, "table_name string, column_name string, max_chars int, overflow_rows long")}


def key_checks(tables: dict[str, DataFrame], contracts: dict[str, Table], prefix: str) -> list[DataFrame]:
    """Primary and unique keys, one scan a table."""
    sets = {n: [list(k) for k in ([contracts[n].key] if contracts[n].key else []) + list(contracts[n].unique)] for n in tables}
    return [key_summaries(df, f"{prefix}.{n}", sets[n]) for n, df in tables.items() if sets[n]]


def fk_checks(tables: dict[str, DataFrame], contracts: dict[str, Table], prefix: str,
              parents: dict[str, tuple[str, DataFrame]]) -> list[DataFrame]:
    """Foreign keys, one shuffle a parent. ``parents`` maps a parent's name to (qualified name, frame)."""
    by_parent: dict[tuple[str, str], list] = {}
    for name, df in tables.items():
        for col, parent, pcol in contracts[name].fks:
            by_parent.setdefault((parent, pcol), []).append((df, col, f"{prefix}.{name}"))
    return [orphan_summaries(relations, parents[parent][1], pcol, parents[parent][0])
            for (parent, pcol), relations in by_parent.items()]


def dq_results(pk: DataFrame, not_null: DataFrame, fk: DataFrame, varchar: DataFrame) -> DataFrame:
    """One row per check and column: how many rows violate it (0 = passed)."""
    parts = [
        pk.select(F.lit("primary_or_unique_key").alias("check_name"), "table_name",
                  F.col("key_columns").alias("column_name"),
                  (F.col("null_key_rows") + F.col("duplicate_key_values")).alias("violations")),
        not_null.select(F.lit("not_null").alias("check_name"), "table_name", "column_name",
                        F.col("null_rows").alias("violations")),
        fk.select(F.lit("foreign_key").alias("check_name"), "table_name", "column_name",
                  F.col("orphan_rows").alias("violations")),
        varchar.select(F.lit("varchar_length").alias("check_name"), "table_name", "column_name",
                       F.col("overflow_rows").alias("violations")),
    ]
    return union_all(parts).select(*DQ_COLUMNS, (F.col("violations") == 0).alias("passed"))
