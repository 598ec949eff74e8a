"""Mart registry and the job that builds the marts.

Three aggregates of the price table feed most marts. A full build writes them once and every mart
reads the written tables, so a lost executor recomputes at most one aggregate and the price table is
scanned 6 times instead of once or more per mart. A single mart is computed directly.

With ``dates`` only these are computed and replaced: every mart but one depends on the prices of its own
date, so the scans are pruned to the partitions of the dates. The comparison with a product's previous date
also needs each product's last row before, which is kept as a table, and is renewed from the first of the dates on.

Every mart keeps a ledger of the loads it was built from (:mod:`gondola.plans.freshness`), which ``renew_marts``
compares with the loads' own: what a build that died left stale is renewed by the next call.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.operators import aggregates
from gondola.plans import freshness, marts
from gondola.schemas import COMPARABLE_PRODUCT, DATE, FACT, BaseTables
from gondola.sources.replacement import Replacement
from gondola.sources.tables import Warehouse, export

#: Shared aggregates: table name -> function of what builders draw on.
SHARED: dict[str, Callable[[MartSources], DataFrame]] = {
    "actividad_por_sucursal": lambda s: aggregates.branch_activity(s.base.precios),
    "sucursales_por_producto": lambda s: aggregates.product_branches(s.base.precios),
    "producto_por_bandera": lambda s: aggregates.product_by_banner(s.branches),
    "productos_por_fecha": lambda s: aggregates.comparable_products(s.base.precios),
}
_SHARED_FOLDER = "_compartidos"


class MartSources:
    """What builders draw on: base tables, shared aggregates and other marts.

    ``store`` writes a shared aggregate where it is first asked for and returns the written table.
    """

    def __init__(
        self,
        base: BaseTables,
        keywords: Sequence[str] = marts.BASKET_KEYWORDS,
        store: Callable[[str, DataFrame], DataFrame] | None = None,
    ):
        self.base = base
        self.keywords = keywords
        self._store = store or (lambda name, frame: frame)
        self._ready: dict[str, DataFrame] = {}

    def provide(self, name: str, frame: DataFrame) -> None:
        """Use a written table instead of recomputing it."""
        self._ready[name] = frame

    def shared(self, name: str) -> DataFrame:
        if name not in self._ready:
            self._ready[name] = self._store(name, SHARED[name](self))
        return self._ready[name]

    @property
    def activity(self) -> DataFrame:
        return self.shared("actividad_por_sucursal")

    @property
    def branches(self) -> DataFrame:
        return self.shared("sucursales_por_producto")

    @property
    def by_banner(self) -> DataFrame:
        return self.shared("producto_por_bandera")

    @property
    def comparables(self) -> DataFrame:
        return self.shared("productos_por_fecha")

    @property
    def places(self) -> DataFrame:
        return aggregates.branch_places(self.base.sucursales)

    @property
    def names(self) -> DataFrame:
        return aggregates.banner_names(self.base.comercios)

    def mart(self, name: str) -> DataFrame:
        if name not in self._ready:
            self._ready[name] = MARTS[name](self)
        return self._ready[name]


#: Every mart in build order.
MARTS: dict[str, Callable[[MartSources], DataFrame]] = {
    "mart_resumen_general": lambda s: marts.resumen_general(s.activity, s.by_banner, s.places),
    "mart_evolucion_productos": lambda s: marts.evolucion_productos(s.comparables),
    "mart_variacion_productos": lambda s: marts.variacion_productos(s.mart("mart_evolucion_productos")),
    "mart_resumen_productos": lambda s: marts.resumen_productos(s.comparables, s.by_banner, s.base.precios),
    "mart_precios_por_comercio": lambda s: marts.precios_por_comercio(s.activity, s.by_banner, s.names),
    "mart_precios_por_ubicacion": lambda s: marts.precios_por_ubicacion(s.activity, s.branches, s.places),
    "mart_promociones": lambda s: marts.promociones(s.base.precios),
    "mart_productos_mayor_dispersion": lambda s: marts.productos_mayor_dispersion(s.comparables, s.by_banner),
    "mart_sucursales_geografia": lambda s: marts.sucursales_geografia(s.base.sucursales, s.base.comercios),
    "mart_calidad_precios": lambda s: marts.calidad_precios(s.activity),
    "mart_productos_comparables": lambda s: marts.productos_comparables(s.comparables),
    "mart_precios_sospechosos": lambda s: marts.precios_sospechosos(s.base.precios),
    "mart_canasta_basica_candidatos": lambda s: marts.canasta_basica_candidatos(
        s.mart("mart_evolucion_productos"), s.keywords
    ),
}

#: Marts that are rebuilt before another when only that one is asked for.
DEPENDENCIES: dict[str, tuple[str, ...]] = {"mart_variacion_productos": ("mart_evolucion_productos",)}

VARIATION, EVOLUTION = "mart_variacion_productos", "mart_evolucion_productos"
#: The last row of every comparable product, for the comparison of the next date.
STATE = "_estado_productos"


def marts_to_build(only: str | None = None) -> list[str]:
    if only is None:
        return list(MARTS)
    if only not in MARTS:
        raise ValueError(f"unknown mart: {only}")
    return [*DEPENDENCIES.get(only, ()), only]


def build_marts(
    warehouse: Warehouse,
    only: str | None = None,
    output: str | None = None,
    keywords: Sequence[str] = marts.BASKET_KEYWORDS,
    dates: Iterable[date] | None = None,
) -> dict[str, int]:
    """Create or replace the marts from the base tables; returns rows per mart.

    ``only`` builds one mart after its dependencies (marts that depend on it stay as they are).
    ``output`` also exports each mart as CSV and Parquet. ``dates`` renews these dates only, in marts that
    a full build has made; rows without a date need a full build.
    """
    names = marts_to_build(only)
    if dates is None:
        return _build(warehouse, dict.fromkeys(names), output, keywords, shared=only is None)
    wanted = sorted(set(dates))
    if not wanted:
        return {}
    warehouse.require(names)
    return _build(warehouse, dict.fromkeys(names, wanted), output, keywords, shared=only is None)


def renew_marts(warehouse: Warehouse, keywords: Sequence[str] = marts.BASKET_KEYWORDS) -> dict[str, int]:
    """Build whatever is not of the latest load of its date, whoever loaded it and whatever died since.

    Marts are renewed at their stale dates; all are built anew where one is not there yet or rows without a date were loaded.
    """
    stale = freshness.stale(warehouse, MARTS)
    if not stale or not warehouse.exists(FACT):
        return {}
    if warehouse.missing(MARTS) or any(freshness.UNDATED in days for days in stale.values()):
        return build_marts(warehouse, keywords=keywords)
    wanted = {name: sorted(map(date.fromisoformat, stale[name])) for name in MARTS if name in stale}
    return _build(warehouse, wanted, None, keywords)


def _build(
    warehouse: Warehouse, wanted: dict[str, list[date] | None], output: str | None, keywords: Sequence[str], shared: bool = True
) -> dict[str, int]:
    """Build marts, each at its dates (None: whole). A mart and its entry in the ledger are replaced together."""
    warehouse.recover()
    base = warehouse.base()
    days = None if None in wanted.values() else sorted(set().union(*wanted.values()))
    if days is not None:
        base = BaseTables(*[frame.where(F.col(DATE).isin(days)) for frame in (base.precios, base.comercios, base.sucursales)])
    folder = f"{_SHARED_FOLDER}/{uuid.uuid4().hex}"
    store = (lambda name, frame: warehouse.store(f"{folder}/{name}", frame)) if shared else None
    sources = MartSources(base, keywords, store)
    if days is not None and EVOLUTION not in wanted:
        sources.provide(EVOLUTION, warehouse.read(EVOLUTION).where(F.col(DATE).isin(days)))
    rows = {}
    try:
        for name, dates in wanted.items():
            replaced = dates
            if dates is None:
                frame = MARTS[name](sources)
            elif name == VARIATION:
                before, recent, earlier = _last_rows(warehouse, dates[0])
                frame = variation_since(before, recent, dates[0])
                replaced = {*dates, *(d for table in (EVOLUTION, name) for d in warehouse.dates(table) if d >= dates[0])}
            else:
                frame = MARTS[name](sources)
                frame = frame if dates == days else frame.where(F.col(DATE).isin(dates))
            change = Replacement(warehouse.root)
            try:
                rows[name] = change.stage(name, frame, replaced)["filas"]
                freshness.stage(change, name, freshness.after_build(warehouse, name, replaced))
                if name == VARIATION and dates is not None:
                    change.stage(STATE, last_rows(before.unionByName(recent)), by_date=False)
                    freshness.stage(change, STATE, earlier | freshness.ledger(warehouse, EVOLUTION))
                change.commit()
            finally:
                change.discard()
            built = warehouse.read(name)
            sources.provide(name, built if days is None else built.where(F.col(DATE).isin(days)))
            if output:
                export(warehouse, name, output)
    finally:
        warehouse.drop_folder(folder)
    return rows


def last_rows(evolution: DataFrame) -> DataFrame:
    """The latest row of every comparable product."""
    columns = evolution.columns
    return evolution.groupBy(*COMPARABLE_PRODUCT).agg(F.max_by(F.struct(*columns), DATE).alias("ultima")).select("ultima.*")


def _last_rows(warehouse: Warehouse, first: date) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Last rows before a date, the rows from it on, and the loads of the dates before.

    The last rows are kept as a table with the loads they come from. They are taken from there if these are all dates before
    ``first`` as they are now, which holds when the newest date is added; else all earlier dates are read.
    """
    evolution = warehouse.read(EVOLUTION)
    earlier = {day: load for day, load in freshness.ledger(warehouse, EVOLUTION).items() if day < first.isoformat()}
    known = earlier and warehouse.exists(STATE) and freshness.ledger(warehouse, STATE) == earlier
    before = warehouse.read(STATE) if known else last_rows(evolution.where(F.col(DATE) < F.lit(first)))
    return before.select(*evolution.columns), evolution.where(F.col(DATE) >= F.lit(first)), earlier


def variation_since(before: DataFrame, recent: DataFrame, first: date) -> DataFrame:
    """The changes at ``first`` and later dates, from the last row of each product before and all rows since."""
    return marts.variacion_productos(before.unionByName(recent)).where(F.col(DATE) >= F.lit(first))
