"""Names for strategies, profiles of settings, and feature sets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..operators import conserve, expand, gridagg, interp, resolve
from ..operators.gridagg import FeatureSpec
from ..operators.quality import EVENT_TYPES
from ..sources import snapshots


class Registry[T]:
    """Names to things; an unknown name's error lists the known ones."""

    def __init__(self, kind: str) -> None:
        self.kind = kind
        self._known: dict[str, T] = {}

    def register(self, name: str, thing: T) -> T:
        if name in self._known:
            raise ValueError(f"{self.kind} {name!r} is there already")
        self._known[name] = thing
        return thing

    def __getitem__(self, name: str) -> T:
        if name not in self._known:
            raise KeyError(f"no {self.kind} {name!r}; there are {sorted(self._known)}")
        return self._known[name]

    def names(self) -> list[str]:
        return sorted(self._known)


@dataclass(frozen=True)
class Viewpoint:
    """How a store becomes one row set."""

    survivorship: str = "annual_wins"
    temporal: str = "even_split"
    spatial: str = "proportional"
    by_source: dict[str, str] = field(default_factory=dict)
    stale_filter: bool = True
    min_pgid: int | None = None
    max_violence: int | None = None
    exclude_precision: tuple[int, ...] = ()

    def with_overrides(self, **changes) -> Viewpoint:
        return replace(self, **changes)


PROFILES: Registry[Viewpoint] = Registry("profile")
PROFILES.register("default", Viewpoint())
PROFILES.register(
    "production_parity",
    Viewpoint("dot9_wins", "ceil_split", "passthrough", {"annual": "date_end_only"}, True, 1, 3, (4, 6)),
)


@dataclass(frozen=True)
class TypedViewpoint:
    """Which event types of the second source stay: all where there are none named."""

    event_types: tuple[str, ...] | None = None


# Profiles of the second source.
TYPED_PROFILES: Registry[TypedViewpoint] = Registry("typed profile")
TYPED_PROFILES.register("acled_all_events", TypedViewpoint())
TYPED_PROFILES.register("acled_violence_only", TypedViewpoint(("Battles", "Explosions/Remote violence", "Violence against civilians")))

# Violence types 1, 2, 3 and the event types of the second source, with their features.
VIOLENCE = (("sb", 1), ("ns", 2), ("os", 3))
CONFLICT_FEATURES = tuple(
    FeatureSpec(f"ged_{name}_{what}", aggregation, "best" if what == "best" else None, {"type_of_violence": code})
    for name, code in VIOLENCE
    for what, aggregation in (("count", "count"), ("best", "sum_field"))
)
TYPES = dict(zip(("battles", "explosions", "vac", "protests", "riots", "strategic"), EVENT_TYPES, strict=True))
TYPED_FEATURES = (
    FeatureSpec("acled_count"),
    *(FeatureSpec(f"acled_{name}", filter={"event_type": kind}) for name, kind in TYPES.items()),
    FeatureSpec("acled_fatalities", "sum_field", "fatalities"),
)


@dataclass(frozen=True)
class CovariateView:
    """Yearly variables of countries or regions: their names, the key, and how gaps between years are filled."""

    variables: tuple[str, ...]
    key: str
    how: str = "step"


@dataclass(frozen=True)
class RasterView:
    """Rasters of epochs: pixels a cell's side, the value of missing ones, and how months between are filled."""

    name: str
    epochs: tuple[int, ...]
    pixels_per_cell: int
    nodata: float
    how: str = "linear"


# Variables, keys, epochs and pixels of the covariates.
COVARIATES: Registry[CovariateView] = Registry("covariate")
COVARIATES.register(
    "vdem",
    CovariateView(
        (
            "v2xcl_dmove", "v2xeg_eqdr", "v2xpe_exlsocgr", "v2x_clphy", "v2xcl_prpty", "v2x_ex_military", "v2x_ex_party", "v2x_horacc",
            "v2xnp_client", "v2xnp_regcorr", "v2xpe_exlgeo", "v2x_veracc", "v2xpe_exlpol", "v2x_diagacc", "v2x_divparctrl", "v2xeg_eqprotec",
            "v2x_genpp", "v2xpe_exlgender", "v2x_hosabort", "v2x_libdem", "v2xcl_rol", "v2x_accountability",
        ),
        "country_text_id",
    ),
)
COVARIATES.register("shdi", CovariateView(("shdi", "healthindex", "edindex", "incindex"), "gdl_code"))
RASTERS: Registry[RasterView] = Registry("raster")
RASTERS.register("ghspop", RasterView("pop_count", (1975, 1980, 1985, 1990, 1995, 2000, 2005, 2010, 2015, 2020, 2025, 2030), 60, -200.0))


def build_covariates(values: DataFrame, crosswalk: DataFrame, view: CovariateView) -> DataFrame:
    """(pgid, month_id, variables) of yearly values (the key, year, variables) for the cells of the key in
    ``crosswalk`` (pgid, key); all variables in one pass.  Variables that the values lack are an error; years from
    a key's first to its last that it lacks repeat the year before (``step``)."""
    missing = [v for v in (view.key, "year", *view.variables) if v not in values.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    rows = values.select(view.key, F.col("year").cast("int").alias("year"), *view.variables)
    if view.how == "step":
        after = F.coalesce(F.lead("year").over(Window.partitionBy(view.key).orderBy("year")), F.col("year") + 1)
        rows = rows.withColumn("_after", after).withColumn("year", F.explode(F.sequence(F.col("year"), F.col("_after") - 1))).drop("_after")
    return expand.years_to_months(rows, crosswalk, view.key)


def build_raster(pixels: DataFrame, months: DataFrame, view: RasterView) -> DataFrame:
    """(pgid, month_id, value) of pixels (epoch, row, col, value) of the view's epochs: sums by cell, and months
    between epochs filled; an epoch counts from its January."""
    at = lambda c: F.floor(F.col(c) / view.pixels_per_cell).cast("int")
    value = F.when((F.col("value") == view.nodata) | (F.col("value") < 0), 0.0).otherwise(F.col("value").cast("double"))
    cells = pixels.where(F.col("epoch").isin(list(view.epochs))).groupBy("epoch", gridagg.raster_block_to_pgid(at("row"), at("col")).alias("pgid")).agg(F.sum(value).alias(view.name))
    if view.how == "linear":
        return interp.linear(cells.withColumnRenamed("epoch", "year"), months, "pgid", view.name)
    january = ((F.col("epoch") - 1980) * 12 + 1).cast("int")
    return interp.step(cells.select("pgid", january.alias("month_id"), view.name), months, "pgid", view.name)


class NotConserved(ValueError):
    """Rows were lost or multiplied on the way."""


@dataclass(frozen=True)
class Build:
    """Rows that are still to be computed, and what is counted while they are.

    ``seen`` are observations: the pass that makes the rows fills them, so counting costs no pass of its own.
    ``equations`` are sums that must hold; ``recount`` counts again in passes of their own, for tasks that ran
    twice (lost executors) are observed twice.
    """

    rows: DataFrame
    seen: tuple[Observation, ...]
    equations: tuple[tuple[str, tuple[str, ...]], ...]
    recount: Callable[[], dict[str, object]]

    def run(self) -> dict[str, object]:
        """Compute the rows for the counts alone."""
        self.rows.write.format("noop").mode("overwrite").save()
        return self.check()

    def check(self) -> dict[str, object]:
        """The counts, after an action that has computed all rows; raise :class:`NotConserved` where one does
        not equal the sum of its parts."""
        seen = [conserve.observed(one) for one in self.seen]
        counts = None if None in seen else {k: v for one in seen for k, v in one.items()}
        if counts is None or self._broken(counts):
            counts = self.recount()
        if broken := self._broken(counts):
            raise NotConserved("; ".join(broken))
        return counts

    def _broken(self, counts: dict[str, object]) -> list[str]:
        n = lambda name: counts[name] or 0
        return [f"{whole} {n(whole)} is not {' + '.join(f'{p} {n(p)}' for p in parts)}" for whole, parts in self.equations if n(whole) != sum(map(n, parts))]

    def write(self, path: str) -> dict[str, object]:
        """Replace the store at ``path``, unless the counts do not add up: then it stays as it was."""
        counts: dict[str, object] = {}
        snapshots.write_store(self.rows, path, check=lambda: counts.update(self.check()))
        return counts


def _count(condition, name: str):
    return F.count(F.when(condition, 1)).alias(name)


def viewpoint(store: DataFrame, view: Viewpoint, polygons: DataFrame | None = None, ties: tuple = ()) -> Build:
    """A store to one row set, with its accounting: stale filter, survivors, months, cells, row filters.

    An event is split into months first, and each month's amounts then go to cells as whole numbers.
    Weights of cells come from all versions that the stale filter leaves, as well-located events of each.
    ``polygons`` has pgid and code, and level (1 and 0) for two levels of them.

    Counted: n_store (rows read) = n_stale + n_superseded + n_survivors (rows decided), n_months = n_kept +
    n_filtered, and ``amount`` of the survivors before, ``amount_by_month`` after the split into months (equal
    under ``even_split``).
    """
    read, decided, split, filtered = (Observation() for _ in range(4))
    n, amount = F.count(F.lit(1)), F.sum("best").cast("double")
    is_ = lambda name: F.col("_status") == name
    rows = resolve.with_status(store.observe(read, n.alias("n_store")), view.stale_filter, view.survivorship, ties)
    rows = rows.observe(
        decided,
        _count(is_("stale"), "n_stale"),
        _count(is_("superseded"), "n_superseded"),
        _count(is_("survivor"), "n_survivors"),
        F.sum(F.when(is_("survivor"), F.col("best"))).cast("double").alias("amount"),
    )
    rows = expand.split_months(rows.where(is_("survivor")).drop("_status"), view.temporal, by_source=view.by_source)
    rows = rows.observe(split, n.alias("n_months"), amount.alias("amount_by_month"))
    if view.spatial not in expand.SPATIAL:
        raise KeyError(f"no spatial rule {view.spatial!r}; there are {sorted(expand.SPATIAL)}")
    rows = expand.SPATIAL[view.spatial](rows, resolve.drop_stale(store) if view.stale_filter else store, polygons)
    distributed = F.col("_spatial_distributed") if "_spatial_distributed" in rows.columns else None
    passes = resolve.passes(view.min_pgid, view.max_violence, view.exclude_precision, distributed)
    rows = rows.observe(filtered, n.alias("n_rows"), _count(passes, "n_kept"), _count(~passes | passes.isNull(), "n_filtered"))
    equations = (("n_store", ("n_stale", "n_superseded", "n_survivors")), ("n_rows", ("n_kept", "n_filtered")))
    return Build(rows.where(passes), (read, decided, split, filtered), equations, lambda: viewpoint_accounting(store, view, ties).head().asDict() | {"n_rows": 0, "n_kept": 0, "n_filtered": 0})


def build_viewpoint(store: DataFrame, view: Viewpoint, polygons: DataFrame | None = None, ties: tuple = ()) -> DataFrame:
    """The rows of :func:`viewpoint`."""
    return viewpoint(store, view, polygons, ties).rows


def viewpoint_totals(store: DataFrame, view: Viewpoint, by: tuple[str, ...], polygons: DataFrame | None = None, ties: tuple = (), amounts: tuple[str, ...] = ("best",)) -> DataFrame:
    """``by``, priogrid_gid, sums of the amounts and ``n``, the number of rows, of :func:`build_viewpoint`.  Under the
    proportional rule its rows, one for each cell of an event's polygon, are not made (:func:`expand.distribute_totals`)."""
    if view.spatial != "proportional" or polygons is None:
        rows = build_viewpoint(store, view, polygons, ties)
        return rows.groupBy(*by, "priogrid_gid").agg(*[F.sum(a).alias(a) for a in amounts], F.count(F.lit(1)).alias("n"))
    rows = resolve.with_status(store, view.stale_filter, view.survivorship, ties).where("_status = 'survivor'")
    rows = expand.split_months(rows, view.temporal, amounts, view.by_source).where(resolve.passes(max_violence=view.max_violence))
    weights = expand.weight_map(resolve.drop_stale(store) if view.stale_filter else store, polygons)
    staying = resolve.passes(exclude_precision=view.exclude_precision)
    return expand.distribute_totals(rows, weights, polygons, by, amounts, staying=staying).where(resolve.passes(view.min_pgid))


def typed(store: DataFrame, view: TypedViewpoint) -> Build:
    """The second source's events of the wanted types (null is none), with ``date_month`` (YYYY-MM), and
    n_input = n_output + n_filtered."""
    seen, kept = Observation(), _wanted(view)
    rows = store.observe(seen, F.count(F.lit(1)).alias("n_input"), _count(kept, "n_output"), _count(~kept, "n_filtered"))
    rows = rows.where(kept).withColumn("date_month", F.substring(F.col("event_date").cast("string"), 1, 7))
    return Build(rows, (seen,), (("n_input", ("n_output", "n_filtered")),), lambda: typed_accounting(store, view).head().asDict())


def build_typed(store: DataFrame, view: TypedViewpoint) -> DataFrame:
    """The rows of :func:`typed`."""
    return typed(store, view).rows


def _wanted(view: TypedViewpoint):
    return F.lit(True) if view.event_types is None else F.coalesce(F.col("event_type").isin(*view.event_types), F.lit(False))


def typed_accounting(store: DataFrame, view: TypedViewpoint) -> DataFrame:
    """One row: n_input = n_output + n_filtered, the last counted on their own."""
    kept = _wanted(view)
    return store.agg(F.count(F.lit(1)).alias("n_input"), _count(kept, "n_output"), _count(~kept, "n_filtered"))


def viewpoint_accounting(store: DataFrame, view: Viewpoint, ties: tuple = ()) -> DataFrame:
    """One row: the counts of :func:`viewpoint` up to the split into months, in passes of their own."""
    rows = resolve.with_status(store, view.stale_filter, view.survivorship, ties)
    is_ = lambda name: F.col("_status") == name
    months = expand.split_months(rows.where(is_("survivor")), view.temporal, by_source=view.by_source)
    decided = rows.agg(
        _count(is_("stale"), "n_stale"),
        _count(is_("superseded"), "n_superseded"),
        _count(is_("survivor"), "n_survivors"),
        F.sum(F.when(is_("survivor"), F.col("best"))).cast("double").alias("amount"),
    )
    by_month = months.agg(F.count(F.lit(1)).alias("n_months"), F.sum("best").cast("double").alias("amount_by_month"))
    return store.agg(F.count(F.lit(1)).alias("n_store")).crossJoin(decided).crossJoin(by_month)  # rows of one each
