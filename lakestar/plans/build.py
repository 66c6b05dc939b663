"""One build over one input folder: raw -> lookups -> silver -> gold, built lazily.

Frames that several later steps read are written once to the reliable checkpoint folder, which also
gives Catalyst their file sizes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.functions.conform import flagged, well_formed
from lakestar.operators import quality
from lakestar.operators.joins import materialize
from lakestar.plans import gold, silver
from lakestar.sources.fixtures import Fixtures

# Fixed "today" for repeatable runs and oracle checks (the reference uses CURRENT_DATE).
DEFAULT_AS_OF = dt.date(2023, 1, 1)


Sink = Callable[[str, str, DataFrame], DataFrame]


class Kept:
    """A sink for queries: tables in the checkpoint folder, with what was observed while they were written.

    ``checked``: whether FK-checked raw tables are written too. Without rejects only their silver table reads them.
    """

    def __init__(self, checked: bool = True):
        self.checked = checked
        self.observed: dict[tuple[str, str], dict] = {}

    def __call__(self, layer: str, name: str, df: DataFrame, metrics: list | None = None,
                 layout: tuple[str, ...] = ()) -> DataFrame:
        if layer == "bronze" and not self.checked:
            return df
        return materialize(df, metrics, layout, self.observed.setdefault((layer, name), {}))


class Build:
    """``sink(layer, name, df)`` writes a finished table and returns it read back.

    Without a sink (query mode) tables stay lazy, and only frames read by
    several later steps are materialised in the checkpoint folder.
    """

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], as_of=DEFAULT_AS_OF,
                 sink: Sink | None = None):
        self.spark = spark
        self.landed = raw
        self.flagged = {t: flagged(df, schemas.RAW[t]) for t, df in raw.items()}
        self.raw = {t: well_formed(df) for t, df in self.flagged.items()}
        self.as_of = as_of
        self.sink = sink
        self._checked: dict[str, DataFrame] = {}     # created here: waves read it from several threads
        self._stars: dict[str, DataFrame] = {}

    @property
    def observed(self) -> dict[tuple[str, str], dict] | None:
        """Metrics observed by a sink that takes them, by (layer, table)."""
        return getattr(self.sink, "observed", None)

    def _out(self, layer: str, name: str, df: DataFrame, reuse: bool = False, metrics: list | None = None) -> DataFrame:
        if self.observed is not None:
            contract = {"silver": {**schemas.SILVER, **schemas.LOOKUPS}, "gold": schemas.GOLD}.get(layer, {}).get(name)
            if contract is not None:
                metrics = quality.column_metrics(contract, name not in schemas.LOOKUPS)
            return self.sink(layer, name, df, metrics=metrics)
        if self.sink is not None:
            return self.sink(layer, name, df)
        return materialize(df) if reuse else df

    def _fact(self, name: str, star: DataFrame) -> DataFrame:
        """The fact rows of a star; a sink that takes a layout gets facts and lost rows in one write."""
        self._stars[name] = star
        if self.sink is None:
            return gold.facts(star, name)
        if self.observed is None:
            return self.sink("gold", name, gold.facts(star, name))
        kept = F.col("kept")
        metrics = quality.column_metrics(schemas.GOLD[name], rows=kept) + [F.count(F.when(kept, F.lit(1))).alias("kept_rows")]
        self._stars[name] = self.sink("gold", name, star, metrics=metrics, layout=schemas.LAYOUT)
        return self._stars[name].where("kept").select(*schemas.GOLD[name].schema.names, "fact_month")

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, as_of=DEFAULT_AS_OF,
                      materialized: bool = False) -> "Build":
        """``materialized``: write every finished table once (for many readers, e.g. checks)."""
        return cls(spark, Fixtures(spark, sf_dir).raw(), as_of, sink=Kept() if materialized else None)

    # ---- lookups ----
    @cached_property
    def _lookup_set(self):
        return silver.all_lookups(self.raw)

    @cached_property
    def lookups(self) -> dict[str, DataFrame]:
        items = list(self._lookup_set.tables.items())
        if self.sink is None:
            return dict(items)
        with ThreadPoolExecutor(max_workers=len(items)) as pool:   # six small independent writes
            return dict(pool.map(lambda kv: (kv[0], self._out("silver", kv[0], kv[1])), items))

    def lk(self, name: str) -> DataFrame:
        return self.lookups[name]

    def vmap(self, name: str) -> DataFrame:
        """Raw value -> id for one lookup (labels computed on distinct raw values only)."""
        return self._lookup_set.value_maps[name]

    # ---- FK-checked raw tables (one set of FK joins feeds silver and rejects) ----
    def checked(self, table: str) -> DataFrame:
        """Raw rows of ``table`` with FK markers, shared by the silver build and the rejects.

        Written once in a run, so the rejects do not repeat the joins.
        """
        if table not in self._checked:
            parents = {p: getattr(self, p) for _, p, _ in silver.FK_TESTS[table]}
            flagged = self.flagged[table]
            self._checked[table] = self._out("bronze", f"{table}_fk_checked",
                                             silver.check_fks(table, flagged, parents),
                                             metrics=quality.precision_metrics(flagged, schemas.SILVER[table]))
        return self._checked[table]

    # ---- silver ----
    @cached_property
    def locations(self) -> DataFrame:
        return self._out("silver", "locations", silver.locations(self.raw["locations"]), reuse=True)

    @cached_property
    def users(self) -> DataFrame:
        return self._out("silver", "users", silver.users(self.raw["users"], checked=self.checked("users")),
                         reuse=True)

    @cached_property
    def watchlist(self) -> DataFrame:
        return self._out("silver", "watchlist", silver.watchlist(self.raw["watchlist"], self.vmap("dim_content_types"),
                                                                  self.vmap("dim_genres")))

    @cached_property
    def devices(self) -> DataFrame:
        return self._out("silver", "devices", silver.devices(self.raw["devices"], None, self.vmap("dim_device_types"),
                                                              self.vmap("dim_os"), checked=self.checked("devices")))

    @cached_property
    def subscriptions(self) -> DataFrame:
        return self._out("silver", "subscriptions", silver.subscriptions(
            self.raw["subscriptions"], None, self.vmap("dim_plan_types"), self.vmap("dim_event_types"),
            checked=self.checked("subscriptions")), reuse=True)

    @cached_property
    def payments(self) -> DataFrame:
        return self._out("silver", "payments", silver.payments(self.raw["payments"], None,
                                                                checked=self.checked("payments")))

    @cached_property
    def viewing_activity(self) -> DataFrame:
        return self._out("silver", "viewing_activity", silver.viewing_activity(
            self.raw["viewing_activity"], None, None, None, checked=self.checked("viewing_activity")))

    def silver_tables(self) -> dict[str, DataFrame]:
        return {"locations": self.locations, "users": self.users, "watchlist": self.watchlist,
                "devices": self.devices, "subscriptions": self.subscriptions, "payments": self.payments,
                "viewing_activity": self.viewing_activity}

    # ---- gold ----
    @cached_property
    def dim_date(self) -> DataFrame:
        return self._out("gold", "dim_date", gold.dim_date(self.spark))

    @cached_property
    def dim_content(self) -> DataFrame:
        return self._out("gold", "dim_content", gold.dim_content(self.watchlist, self.lk("dim_content_types"),
                                                                  self.lk("dim_genres")))

    @cached_property
    def dim_user(self) -> DataFrame:
        return self._out("gold", "dim_user", gold.dim_user(self.users, self.locations, self.subscriptions,
                                                           self.lk("dim_plan_types"), self.as_of), reuse=True)

    @cached_property
    def fact_subscription_events(self) -> DataFrame:
        return self._fact("fact_subscription_events", gold.star_subscription_events(
            self.payments, self.subscriptions, self.dim_user, self.dim_date, self.lk("dim_event_types")))

    @cached_property
    def fact_viewing_activity(self) -> DataFrame:
        return self._fact("fact_viewing_activity", gold.star_viewing_activity(
            self.viewing_activity, self.dim_user, self.dim_content, self.dim_date))

    def star(self, name: str) -> DataFrame:
        """All source rows of a fact, lost ones included."""
        getattr(self, name)
        return self._stars[name]

    @property
    def fact_rejects(self) -> DataFrame:
        """Source rows that became no fact, counted by the lookup that failed and its key."""
        return reduce(lambda a, b: a.unionByName(b), [gold.lost(self.star(n), n) for n in schemas.FACTS])

    @cached_property
    def mrr_by_month_event(self) -> DataFrame:
        return gold.mrr_by_month_event(self.fact_subscription_events, self.dim_date)

    def gold_tables(self) -> dict[str, DataFrame]:
        return {"dim_date": self.dim_date, "dim_content": self.dim_content, "dim_user": self.dim_user,
                "fact_subscription_events": self.fact_subscription_events,
                "fact_viewing_activity": self.fact_viewing_activity}
