"""Lookup tables: distinct labels with dense surrogate ids, raw-value maps, attaching ids / names."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.operators.joins import materialize
from lakestar.operators.keys import dense_ids


@dataclass
class LookupSet:
    """Lookup tables ``(id, name)`` plus, per lookup, a ``(raw_value, id)`` map.

    Labels are computed once per *distinct raw value*, never per row; the
    build attaches ids by joining the raw column against the
    value map, so title-casing and prefix rules do not run on the big tables.
    """
    tables: dict[str, DataFrame]
    value_maps: dict[str, DataFrame]


def build_lookups(sources: dict[str, DataFrame],
                  specs: dict[str, tuple[str, str, Callable[[Column], Column], str, str]]) -> LookupSet:
    """Several lookups from one job: ``specs[name] = (source, raw column, label fn, id col, name col)``.

    Each source is scanned once; its non-NULL raw values are exploded into
    ``(lookup, raw_value)`` pairs, and one distinct over the union is written.
    """
    parts = []
    for src_name in dict.fromkeys(s[0] for s in specs.values()):
        mine = [(n, s) for n, s in specs.items() if s[0] == src_name]
        pairs = F.array(*[F.when(F.col(raw_col).isNotNull(),
                                 F.struct(F.lit(n).alias("lookup"), F.col(raw_col).cast("string").alias("raw_value")))
                          for n, (_, raw_col, _, _, _) in mine])
        parts.append(sources[src_name].select(F.explode(pairs).alias("p")).select("p.lookup", "p.raw_value"))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    values = materialize(union.where(F.col("lookup").isNotNull()).distinct())
    label = None
    for n, (_, _, fn, _, _) in specs.items():
        cond = F.col("lookup") == F.lit(n)
        label = F.when(cond, fn(F.col("raw_value"))) if label is None else label.when(cond, fn(F.col("raw_value")))
    labeled = values.select("lookup", "raw_value", label.alias("label"))
    # all labels are numbered in one go, each lookup from 1 by ascending name, whatever their number
    names = labeled.where(F.col("label").isNotNull()).select("lookup", F.col("label").alias("name")).distinct()
    numbered_all = materialize(dense_ids(names, "name", "id", group_col="lookup"))
    # raw value -> id for every lookup, written once as well (a join of two written frames)
    maps_all = materialize(labeled.join(numbered_all.select("lookup", F.col("name").alias("label"), "id"),
                                        ["lookup", "label"]).select("lookup", "raw_value", "id"))
    tables, maps = {}, {}
    for n, (_, _, _, id_col, name_col) in specs.items():
        mine = numbered_all.where(F.col("lookup") == n)
        tables[n] = mine.select(F.col("id").alias(id_col), F.col("name").alias(name_col))
        maps[n] = maps_all.where(F.col("lookup") == n).select("raw_value", "id")
    return LookupSet(tables, maps)


def attach_id_by_value(df: DataFrame, raw_col: str, value_map: DataFrame, id_col: str) -> DataFrame:
    """Left-join ``raw value -> id``; a NULL or unknown raw value gets a NULL id."""
    vm = value_map.select(F.col("raw_value").alias("__rv"), F.col("id").alias(id_col))
    return df.join(vm, df[raw_col].cast("string") == F.col("__rv"), "left").drop("__rv")


def attach_name(df: DataFrame, id_col: str, lookup: DataFrame, name_col: str, alias: str | None = None) -> DataFrame:
    """Left-join id -> name."""
    lk = lookup.select(F.col(lookup.columns[0]).alias("__lk_id"), F.col(name_col).alias(alias or name_col))
    return df.join(lk, df[id_col] == lk["__lk_id"], "left").drop("__lk_id")
