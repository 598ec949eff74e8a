"""Saved analytic queries: overview (a), price quality (b) and evolution (e).

Those over the marts take the mart; those over the base tables take the shared aggregates or the base
tables. Every cut-off result has a complete order, so repeated runs return the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import contains_text, first_rows, mean, null_safe_join, nulls_last, percent_change
from gondola.operators.aggregates import branch_places, comparable_products, times
from gondola.plans import marts
from gondola.schemas import (
    BANNER_KEY,
    BRANCH_KEY,
    COMPARABLE_PRODUCT,
    DATE,
    PRICE,
    PRODUCT_KEY,
    REFERENCE_PRICE,
    BaseTables,
)

MIN_ROWS = 20
_UNIT_KEY = COMPARABLE_PRODUCT[1:]


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


# --- overview of the base tables: keys are compared as concatenated text, so NULL parts are not counted


def general_summary(activity: DataFrame, by_banner: DataFrame, places: DataFrame) -> DataFrame:
    located = activity.join(places, BRANCH_KEY, "left")
    coverage = located.groupBy(DATE).agg(
        F.sum(times("filas")).alias("cantidad_registros_precios"),
        F.count_distinct("id_comercio").alias("cantidad_comercios"),
        F.count_distinct("id_comercio", "id_bandera").alias("cantidad_banderas"),
        F.count_distinct("id_comercio", "id_bandera", "id_sucursal").alias("cantidad_sucursales"),
        F.count_distinct("sucursales_provincia").alias("cantidad_provincias"),
        F.count_distinct("sucursales_localidad").alias("cantidad_localidades"),
    )
    products = marts.products_per_date(by_banner)
    return null_safe_join(coverage, products, [DATE], "inner").orderBy(*nulls_last([DATE]))


def product_summary(comparables: DataFrame, by_banner: DataFrame, prices: DataFrame) -> DataFrame:
    frame = marts.resumen_productos(comparables, by_banner, prices, null_ids_count=False)
    return frame.orderBy(*nulls_last([DATE]), F.desc("cantidad_registros"))


def price_by_chain(activity: DataFrame, by_banner: DataFrame, names: DataFrame) -> DataFrame:
    frame = marts.precios_por_comercio(activity, by_banner, names, null_ids_count=False)
    return frame.orderBy(*nulls_last([DATE]), F.desc("cantidad_registros"))


def price_by_place(activity: DataFrame, branches: DataFrame, places: DataFrame) -> DataFrame:
    frame = marts.precios_por_ubicacion(activity, branches, places, null_ids_count=False)
    return frame.orderBy(*nulls_last([DATE, "sucursales_provincia", "sucursales_localidad"]))


def promoted_products(promotions: DataFrame) -> DataFrame:
    return promotions.orderBy(
        *nulls_last([DATE]), F.desc("cantidad_registros_con_promo1"), F.desc("cantidad_registros_con_promo2")
    )


def widest_spread(comparables: DataFrame, by_banner: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    frame = marts.productos_mayor_dispersion(comparables, by_banner, min_rows, null_ids_count=False)
    return frame.orderBy(F.col("diferencia_absoluta_max_min").desc_nulls_last(), F.desc("cantidad_registros"))


def find_prices(base: BaseTables, text: str) -> DataFrame:
    """Single prices of the products whose description contains a text, cheapest first.

    The text is compared in upper case, and as typed: write it in capitals.
    """
    pattern = "%" + text.replace("\\", "\\\\") + "%"
    return (
        base.precios.where(F.upper("productos_descripcion").like(pattern))
        .join(base.comercios.select(*BANNER_KEY, "comercio_bandera_nombre"), BANNER_KEY, "left")
        .join(
            base.sucursales.select(
                *BRANCH_KEY, "sucursales_nombre", "sucursales_localidad", "sucursales_provincia"
            ),
            BRANCH_KEY,
            "left",
        )
        .select(
            *PRODUCT_KEY,
            "productos_descripcion",
            "productos_marca",
            "id_comercio",
            "id_bandera",
            "comercio_bandera_nombre",
            "id_sucursal",
            "sucursales_nombre",
            "sucursales_localidad",
            "sucursales_provincia",
            PRICE,
            "productos_precio_unitario_promo1",
            "productos_leyenda_promo1",
            "productos_precio_unitario_promo2",
            "productos_leyenda_promo2",
        )
        .orderBy(F.col(PRICE).asc_nulls_last())
    )


def located_branches(geography: DataFrame) -> DataFrame:
    return geography.orderBy(
        *nulls_last([DATE, "sucursales_provincia", "sucursales_localidad", "comercio_bandera_nombre"])
    )


# --- price quality


def _price_rows(prices: DataFrame, condition: Column, limit: int | None) -> DataFrame:
    """All rows without an order of their own, or the first ``limit`` in the order of their columns."""
    columns = [DATE, *COMPARABLE_PRODUCT, PRICE, REFERENCE_PRICE]
    rows = prices.where(condition).select(*columns)
    return rows if limit is None else rows.orderBy(*nulls_last(columns)).limit(limit)


def non_positive_prices(prices: DataFrame, limit: int | None = None) -> DataFrame:
    return _price_rows(prices, F.col(PRICE) <= 0, limit)


def very_low_prices(prices: DataFrame, limit: int | None = None) -> DataFrame:
    return _price_rows(prices, (F.col(PRICE) > 0) & (F.col(PRICE) < marts.LOW_PRICE), limit)


def highest_prices(prices: DataFrame, limit: int = 100) -> DataFrame:
    """Products with the highest observed price; aggregated before sorting."""
    return (
        prices.where(F.col(PRICE).isNotNull())
        # By text first: a hash aggregation, after which few rows are left for the MIN over texts.
        .groupBy(*PRODUCT_KEY, "productos_descripcion", "productos_marca")
        .agg(F.max(PRICE).alias("maximo"), F.count("*").alias("filas"))
        .groupBy(*PRODUCT_KEY)
        .agg(
            F.min("productos_descripcion").alias("productos_descripcion"),
            F.min("productos_marca").alias("productos_marca"),
            F.max("maximo").alias("precio_maximo"),
            F.sum("filas").alias("cantidad_registros"),
        )
        .orderBy(F.col("precio_maximo").desc_nulls_last(), *nulls_last(PRODUCT_KEY))
        .limit(limit)
    )


def high_percentiles(prices: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Approximate 95th and 99th percentile per date, from one bounded sketch each."""
    return (
        prices.where(F.col(PRICE).isNotNull())
        .groupBy(DATE)
        .agg(
            F.percentile_approx(PRICE, [0.95, 0.99], accuracy).alias("percentiles"),
            F.max(PRICE).alias("precio_maximo"),
        )
        .select(
            DATE,
            F.get("percentiles", F.lit(0)).alias("precio_p95_aproximado"),
            F.get("percentiles", F.lit(1)).alias("precio_p99_aproximado"),
            "precio_maximo",
        )
    )


def summary_by_unit(prices: DataFrame) -> DataFrame:
    """Products and price range per presentation unit over all dates.

    Units are few and one may hold most rows; reducing to unit and product first makes the distinct
    count a plain count.
    """
    unit = "productos_unidad_medida_presentacion"
    return (
        prices.where(F.col(PRICE).isNotNull())
        .groupBy(unit, "id_producto")
        .agg(
            F.count("*").alias("filas"),
            F.sum(PRICE).alias("suma"),
            F.min(PRICE).alias("minimo"),
            F.max(PRICE).alias("maximo"),
        )
        .groupBy(unit)
        .agg(
            F.count("id_producto").alias("cantidad_productos"),
            mean(F.sum("suma"), F.sum("filas")).alias("precio_promedio"),
            F.min("minimo").alias("precio_minimo"),
            F.max("maximo").alias("precio_maximo"),
        )
    )


def comparable_summary(prices: DataFrame) -> DataFrame:
    return marts.evolucion_productos(comparable_products(prices))


def find_products(
    base: BaseTables,
    text: str,
    brand: str | None = None,
    unit: str | None = None,
    province: str | None = None,
    locality: str | None = None,
    limit: int = 100,
) -> DataFrame:
    """Comparable products matching a text and optional filters, cheapest first; ``None`` filters nothing.

    Prices are reduced per branch and product before they meet the branch locations, whose
    multiplicity then weighs the counts and averages.
    """
    found = base.precios.where(F.col(PRICE).isNotNull() & contains_text("productos_descripcion", text))
    if brand is not None:
        found = found.where(F.col("productos_marca") == brand)
    if unit is not None:
        found = found.where(F.col("productos_unidad_medida_presentacion") == unit)
    per_branch = found.groupBy(*BRANCH_KEY, *COMPARABLE_PRODUCT).agg(
        F.count("*").alias("filas"),
        F.sum(PRICE).alias("suma"),
        F.min(PRICE).alias("minimo"),
        F.max(PRICE).alias("maximo"),
        F.count(REFERENCE_PRICE).alias("filas_referencia"),
        F.sum(REFERENCE_PRICE).alias("suma_referencia"),
    )
    placed = per_branch.join(branch_places(base.sucursales), BRANCH_KEY, "left")
    if province is not None:
        placed = placed.where(F.col("sucursales_provincia") == province)
    if locality is not None:
        placed = placed.where(F.col("sucursales_localidad") == locality)
    return (
        placed.groupBy(DATE, *COMPARABLE_PRODUCT)
        .agg(
            F.sum(times("filas")).alias("cantidad_registros"),
            F.min("minimo").alias("precio_minimo"),
            F.max("maximo").alias("precio_maximo"),
            mean(F.sum(times("suma")), F.sum(times("filas"))).alias("precio_promedio"),
            mean(F.sum(times("suma_referencia")), F.sum(times("filas_referencia"))).alias(
                "precio_referencia_promedio"
            ),
        )
        .orderBy(*nulls_last(["precio_minimo", "precio_promedio", DATE, *COMPARABLE_PRODUCT]))
        .limit(limit)
    )


def basket_candidates(prices: DataFrame, keywords: Sequence[str] = marts.BASKET_KEYWORDS) -> DataFrame:
    return marts.canasta_basica_candidatos(comparable_summary(prices), keywords)


# --- evolution between dates, from the marts

_CHANGE = [
    "precio_promedio_anterior",
    "precio_promedio_actual",
    "variacion_absoluta",
    "variacion_porcentual",
    "cantidad_registros_anterior",
    "cantidad_registros_actual",
]


def evolution_of(evolution: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    found = evolution.where(contains_text("productos_descripcion", text))
    order = [*nulls_last([DATE]), F.desc("cantidad_registros"), *nulls_last(COMPARABLE_PRODUCT)]
    return first_rows(found.orderBy(*order), limit)


def enough_rows(min_rows: int) -> Column:
    return (F.col("cantidad_registros_anterior") >= min_rows) & (F.col("cantidad_registros_actual") >= min_rows)


def change_ranking(changes: DataFrame, rising: bool) -> tuple[Column, list[Column]]:
    """Filter and order of a ranking of increases or decreases."""
    amount, percent = F.col("variacion_absoluta"), F.col("variacion_porcentual")
    condition = percent.isNotNull() & ((amount > 0) if rising else (amount < 0))
    order = [percent.desc() if rising else percent.asc(), F.desc("cantidad_registros_actual")]
    return condition, [*order, *nulls_last(COMPARABLE_PRODUCT)]


def largest_changes(
    changes: DataFrame, on: date | str, rising: bool, min_rows: int = MIN_ROWS, limit: int = 50
) -> DataFrame:
    condition, order = change_ranking(changes, rising)
    return (
        changes.where((F.col(DATE) == day(on)) & enough_rows(min_rows) & condition)
        .orderBy(*order)
        .limit(limit)
        .select(DATE, "fecha_anterior", *_UNIT_KEY, *_CHANGE)
    )


def largest_increases(changes: DataFrame, on: date | str, min_rows: int = MIN_ROWS, limit: int = 50) -> DataFrame:
    return largest_changes(changes, on, True, min_rows, limit)


def largest_decreases(changes: DataFrame, on: date | str, min_rows: int = MIN_ROWS, limit: int = 50) -> DataFrame:
    return largest_changes(changes, on, False, min_rows, limit)


def two_dates(summary: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """The one-row comparison of two dates, as one conditional aggregation; empty if a date is missing."""

    def at(when: date | str, column: str) -> Column:
        return F.max(F.when(F.col(DATE) == day(when), F.col(column)))

    sides = summary.where(F.col(DATE).isin(day(start), day(end))).agg(
        at(start, DATE).alias("fecha_inicial"),
        at(end, DATE).alias("fecha_final"),
        at(start, "cantidad_registros_precios").alias("registros_iniciales"),
        at(end, "cantidad_registros_precios").alias("registros_finales"),
        at(start, "cantidad_productos_unicos").alias("productos_iniciales"),
        at(end, "cantidad_productos_unicos").alias("productos_finales"),
        at(start, "precio_promedio_general").alias("precio_promedio_inicial"),
        at(end, "precio_promedio_general").alias("precio_promedio_final"),
    )
    return sides.where(F.col("fecha_inicial").isNotNull() & F.col("fecha_final").isNotNull())


def compare_dates(summary: DataFrame, start: date | str, end: date | str) -> DataFrame:
    return two_dates(summary, start, end).select(
        "fecha_inicial",
        "fecha_final",
        "registros_iniciales",
        "registros_finales",
        (F.col("registros_finales") - F.col("registros_iniciales")).alias("diferencia_registros"),
        "productos_iniciales",
        "productos_finales",
        (F.col("productos_finales") - F.col("productos_iniciales")).alias("diferencia_productos"),
        "precio_promedio_inicial",
        "precio_promedio_final",
        percent_change(F.col("precio_promedio_final"), F.col("precio_promedio_inicial")).alias(
            "variacion_porcentual_precio_promedio"
        ),
    )


def comparable_enough(changes: DataFrame, min_rows: int = MIN_ROWS, limit: int | None = None) -> DataFrame:
    order = [F.desc(DATE), F.desc("cantidad_registros_actual"), *nulls_last(COMPARABLE_PRODUCT)]
    return first_rows(changes.where(enough_rows(min_rows)).orderBy(*order), limit).select(
        DATE,
        "fecha_anterior",
        *_UNIT_KEY,
        "cantidad_registros_anterior",
        "cantidad_registros_actual",
        "precio_promedio_anterior",
        "precio_promedio_actual",
        "variacion_porcentual",
    )


def widest_changes(
    changes: DataFrame, start: date | str, end: date | str, min_rows: int = MIN_ROWS, limit: int = 100
) -> DataFrame:
    return (
        changes.where(
            (F.col("fecha_anterior") == day(start)) & (F.col(DATE) == day(end)) & enough_rows(min_rows)
        )
        .orderBy(F.abs("variacion_porcentual").desc_nulls_last(), *nulls_last(COMPARABLE_PRODUCT))
        .limit(limit)
        .select(*_UNIT_KEY, *_CHANGE[:4])
    )
