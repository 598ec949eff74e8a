"""Parameterised dashboard queries: one function per screen element, mart in, DataFrame out.

Optional filters are only added when given. A date filter on a mart partitioned by date prunes the
scan to that date; ordered, limited results plan as a bounded top-k. Rankings have a default length;
listings, selection lists and series are whole unless the caller gives a limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.columns import contains_text, filled, first_rows, nulls_last
from gondola.plans.marts import BASKET_KEYWORDS
from gondola.plans.saved_queries import MIN_ROWS, change_ranking, day, enough_rows, two_dates
from gondola.schemas import COMPARABLE_PRODUCT, DATE, PRICE, REFERENCE_PRICE

_PRESENTATION = COMPARABLE_PRODUCT[1:]
_UNIT = "productos_unidad_medida_presentacion"
_BRAND = "productos_marca"


def on_date(mart: DataFrame, when: date | str) -> DataFrame:
    return mart.where(F.col(DATE) == day(when))


def choices(mart: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct non-empty values of a column in order, for a selection list."""
    values = mart.where(filled(column)).select(column).distinct().orderBy(column)
    return first_rows(values, limit)


def _equal(frame: DataFrame, column: str, value: str | None) -> DataFrame:
    return frame if value is None else frame.where(F.col(column) == value)


def _matching(frame: DataFrame, text: str) -> DataFrame:
    """Description filter; a blank text filters nothing."""
    return frame.where(contains_text("productos_descripcion", text)) if text.strip() else frame


def _max_price(frame: DataFrame, price: float) -> DataFrame:
    """Upper bound for the lowest price; zero means none."""
    return frame.where(F.col("precio_minimo") <= price) if price > 0 else frame


# --- overview


def headline(summary: DataFrame, when: date | str) -> DataFrame:
    return (
        on_date(summary, when)
        .select("cantidad_registros_precios", "cantidad_productos_unicos", "cantidad_sucursales")
        .limit(1)
    )


def loaded_dates(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count_distinct(DATE).alias("fechas_cargadas"))


def publication_dates(summary: DataFrame) -> DataFrame:
    return summary.where(F.col(DATE).isNotNull()).select(DATE).distinct().orderBy(F.desc(DATE))


def latest_date(summary: DataFrame) -> DataFrame:
    return summary.agg(F.max(DATE).alias(DATE))


def summary_of(summary: DataFrame, when: date | str) -> DataFrame:
    return on_date(summary, when)


def chains(by_chain: DataFrame, when: date | str, limit: int | None = None) -> DataFrame:
    ranked = on_date(by_chain, when).orderBy(
        F.desc("cantidad_productos"), *nulls_last(["comercio_bandera_nombre", "id_comercio", "id_bandera"])
    )
    return first_rows(ranked, limit).select(
        "comercio_bandera_nombre",
        "cantidad_registros",
        "cantidad_productos",
        "cantidad_sucursales",
        "precio_promedio",
        "precio_minimo",
        "precio_maximo",
    )


def search_products(products: DataFrame, when: date | str, text: str, limit: int = 100) -> DataFrame:
    return (
        on_date(products, when)
        .where(contains_text("productos_descripcion", text))
        .orderBy(*nulls_last(["precio_minimo", "id_producto"]))
        .limit(limit)
        .select(
            "id_producto",
            "productos_descripcion",
            _BRAND,
            "cantidad_registros",
            "precio_minimo",
            "precio_maximo",
            "precio_promedio",
            "precio_mediano_aproximado",
            "diferencia_absoluta_max_min",
            "diferencia_porcentual_max_min",
        )
    )


# --- quality


def quality_of(quality: DataFrame, when: date | str) -> DataFrame:
    return on_date(quality, when)


def suspicious_rows(suspicious: DataFrame, when: date | str, limit: int | None = None) -> DataFrame:
    columns = [DATE, "regla_calidad", *COMPARABLE_PRODUCT, PRICE, REFERENCE_PRICE]
    return first_rows(on_date(suspicious, when).select(*columns).orderBy(*nulls_last(columns)), limit)


# --- advanced search and basket


def brand_choices(comparables: DataFrame, when: date | str, limit: int | None = None) -> DataFrame:
    return choices(on_date(comparables, when), _BRAND, limit)


def unit_choices(comparables: DataFrame, when: date | str) -> DataFrame:
    return choices(on_date(comparables, when), _UNIT)


def advanced_search(
    comparables: DataFrame,
    when: date | str,
    text: str = "",
    brand: str | None = None,
    unit: str | None = None,
    max_price: float = 0,
    min_rows: int = MIN_ROWS,
    limit: int = 100,
) -> DataFrame:
    found = _matching(on_date(comparables, when).where(F.col("cantidad_registros") >= min_rows), text)
    found = _max_price(_equal(_equal(found, _BRAND, brand), _UNIT, unit), max_price)
    return (
        found.orderBy(
            *nulls_last(["precio_minimo"]), F.desc("cantidad_registros"), *nulls_last(COMPARABLE_PRODUCT)
        )
        .limit(limit)
        .select(
            *_PRESENTATION,
            "cantidad_registros",
            "precio_minimo",
            "precio_maximo",
            "precio_promedio",
            "precio_referencia_promedio",
            "diferencia_porcentual_max_min",
        )
    )


def basket_unit_choices(basket: DataFrame, when: date | str) -> DataFrame:
    return choices(on_date(basket, when), _UNIT)


def basket_top(
    basket: DataFrame,
    when: date | str,
    categories: Sequence[str] = BASKET_KEYWORDS,
    min_rows: int = MIN_ROWS,
    max_price: float = 0,
    unit: str | None = None,
    per_category: int = 20,
) -> DataFrame:
    """Best-covered candidates of each category, the cheaper ones first among equals.

    A category may hold most of the basket; Spark keeps ``per_category`` rows per map task before the
    shuffle (window group limit), so no task receives a whole category.
    """
    rank_order = [F.desc("cantidad_registros"), *nulls_last(["precio_minimo", *COMPARABLE_PRODUCT])]
    ranking = Window.partitionBy("categoria_canasta").orderBy(*rank_order)
    wanted = on_date(basket, when).where(
        F.col("categoria_canasta").isin(*categories) & (F.col("cantidad_registros") >= min_rows)
    )
    return (
        _equal(_max_price(wanted, max_price), _UNIT, unit)
        .withColumn("orden_categoria", F.row_number().over(ranking))
        .where(F.col("orden_categoria") <= per_category)
        .orderBy("categoria_canasta", *rank_order)
        .select("categoria_canasta", *_PRESENTATION, "precio_minimo", "precio_promedio", "cantidad_registros")
    )


# --- comparison of two dates


def date_metrics(summary: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Metrics of two dates and their differences; the percentage needs a base other than zero."""
    first, last = F.col("precio_promedio_inicial"), F.col("precio_promedio_final")
    return two_dates(summary, start, end).select(
        "*",
        (F.col("registros_finales") - F.col("registros_iniciales")).alias("diferencia_registros"),
        (F.col("productos_finales") - F.col("productos_iniciales")).alias("diferencia_productos"),
        (last - first).alias("diferencia_precio_promedio"),
        F.when(first != 0, (last - first) / first * 100).alias("variacion_porcentual_precio_promedio"),
    )


def date_pair(changes: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Changes between exactly these two dates.

    The mart holds each product's change against its own previous date, so a pair of dates that are
    not neighbours for a product has no row.
    """
    return changes.where((F.col(DATE) == day(end)) & (F.col("fecha_anterior") == day(start)))


def pair_unit_choices(
    changes: DataFrame, start: date | str, end: date | str, limit: int | None = None
) -> DataFrame:
    return choices(date_pair(changes, start, end), _UNIT, limit)


def pair_changes(
    changes: DataFrame,
    start: date | str,
    end: date | str,
    rising: bool,
    min_rows: int = MIN_ROWS,
    unit: str | None = None,
    limit: int = 50,
) -> DataFrame:
    condition, order = change_ranking(changes, rising)
    pair = _equal(date_pair(changes, start, end), _UNIT, unit)
    return (
        pair.where(enough_rows(min_rows) & condition)
        .orderBy(*order)
        .limit(limit)
        .select(
            *_PRESENTATION,
            "precio_promedio_anterior",
            "precio_promedio_actual",
            "variacion_absoluta",
            "variacion_porcentual",
            "cantidad_registros_anterior",
            "cantidad_registros_actual",
        )
    )


# --- evolution of one product


def text_brand_choices(evolution: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    return choices(evolution.where(contains_text("productos_descripcion", text)), _BRAND, limit)


def text_unit_choices(evolution: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    return choices(evolution.where(contains_text("productos_descripcion", text)), _UNIT, limit)


def product_candidates(
    evolution: DataFrame, text: str, brand: str | None = None, unit: str | None = None, limit: int = 100
) -> DataFrame:
    """Products matching a text, those seen on most dates first."""
    found = evolution.where(contains_text("productos_descripcion", text))
    return (
        _equal(_equal(found, _BRAND, brand), _UNIT, unit)
        .groupBy(*COMPARABLE_PRODUCT)
        .agg(
            F.count_distinct(DATE).alias("fechas_disponibles"),
            F.sum("cantidad_registros").alias("registros_totales"),
        )
        .orderBy(F.desc("fechas_disponibles"), F.desc("registros_totales"), *nulls_last(COMPARABLE_PRODUCT))
        .limit(limit)
    )


def product_series(
    evolution: DataFrame,
    product_id: str,
    description: str | None,
    brand: str | None,
    quantity: float | None,
    unit: str | None,
    limit: int | None = None,
) -> DataFrame:
    """Price series of one comparable product, over all dates; NULL parts of its key match NULL."""
    rest: Column = F.lit(True)
    for column, value in zip(_PRESENTATION, (description, brand, quantity, unit)):
        rest = rest & F.col(column).eqNullSafe(F.lit(value))
    series = evolution.where((F.col("id_producto") == product_id) & rest).orderBy(*nulls_last([DATE]))
    return first_rows(series, limit).select(
        DATE,
        "cantidad_registros",
        "precio_minimo",
        "precio_maximo",
        "precio_promedio",
        "precio_referencia_promedio",
    )


def series_change(series: DataFrame) -> DataFrame:
    """First and last average of a series and the change between them."""
    first, last = F.col("promedio_inicial"), F.col("promedio_final")
    return (
        series.agg(
            F.min(DATE).alias("primera_fecha"),
            F.max(DATE).alias("ultima_fecha"),
            F.min_by("precio_promedio", DATE).alias("promedio_inicial"),
            F.max_by("precio_promedio", DATE).alias("promedio_final"),
        )
        .where(F.col("primera_fecha").isNotNull())
        .select(
            "*",
            (last - first).alias("variacion_absoluta"),
            F.when(first != 0, (last - first) / first * 100).alias("variacion_porcentual"),
        )
    )


def series_by_metric(series: DataFrame) -> DataFrame:
    """The series in long form, one row per date and metric, for a line chart."""
    return series.unpivot([DATE], ["precio_promedio", "precio_minimo", "precio_maximo"], "metrica", "precio")


# --- places, promotions, spread, branches


def province_choices(by_place: DataFrame, when: date | str) -> DataFrame:
    province = "sucursales_provincia"
    return on_date(by_place, when).where(F.col(province).isNotNull()).select(province).distinct().orderBy(province)


def locality_choices(by_place: DataFrame, when: date | str, province: str) -> DataFrame:
    locality = "sucursales_localidad"
    rows = _equal(on_date(by_place, when), "sucursales_provincia", province)
    return rows.where(F.col(locality).isNotNull()).select(locality).distinct().orderBy(locality)


def places(
    by_place: DataFrame,
    when: date | str,
    province: str | None = None,
    locality: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    rows = _equal(_equal(on_date(by_place, when), "sucursales_provincia", province), "sucursales_localidad", locality)
    order = [F.desc("cantidad_productos"), *nulls_last(["sucursales_localidad", "sucursales_provincia"])]
    return first_rows(rows.orderBy(*order), limit).drop(DATE)


def busiest_places(shown: DataFrame, limit: int = 30) -> DataFrame:
    order = [F.desc("cantidad_productos"), *nulls_last(["sucursales_localidad", "sucursales_provincia"])]
    return shown.orderBy(*order).limit(limit)


def promotions_of(promotions: DataFrame, when: date | str, limit: int = 300) -> DataFrame:
    promoted = F.col("cantidad_registros_con_promo1") + F.col("cantidad_registros_con_promo2")
    return (
        on_date(promotions, when)
        .orderBy(promoted.desc(), *nulls_last(["productos_descripcion", "id_producto"]))
        .limit(limit)
        .select(
            "productos_descripcion",
            _BRAND,
            "cantidad_registros_con_promo1",
            "cantidad_registros_con_promo2",
            "precio_promedio_lista",
            "precio_promedio_promo1",
            "precio_promedio_promo2",
        )
    )


def spread_of(dispersion: DataFrame, when: date | str, limit: int = 100) -> DataFrame:
    return (
        on_date(dispersion, when)
        .orderBy(
            F.col("diferencia_absoluta_max_min").desc_nulls_last(),
            F.desc("cantidad_registros"),
            *nulls_last(["id_producto"]),
        )
        .limit(limit)
        .select(
            "productos_descripcion",
            _BRAND,
            "cantidad_registros",
            "precio_minimo",
            "precio_maximo",
            "precio_promedio",
            "diferencia_absoluta_max_min",
            "diferencia_porcentual_max_min",
        )
    )


def branches_of(geography: DataFrame, when: date | str, limit: int | None = None) -> DataFrame:
    shown = [
        "comercio_bandera_nombre",
        "sucursales_nombre",
        "sucursales_localidad",
        "sucursales_provincia",
        "sucursales_latitud",
        "sucursales_longitud",
    ]
    order = ["sucursales_provincia", "sucursales_localidad", "comercio_bandera_nombre"]
    rest = [c for c in shown if c not in order]
    return first_rows(on_date(geography, when).select(*shown).orderBy(*nulls_last([*order, *rest])), limit)


def map_points(shown: DataFrame) -> DataFrame:
    return shown.select(
        F.col("sucursales_latitud").alias("lat"), F.col("sucursales_longitud").alias("lon")
    ).dropna()
