"""The thirteen marts. Each builder is a plain ``DataFrame -> DataFrame`` function.

Builders take the shared aggregates of :mod:`gondola.operators.aggregates` (or other marts) where the
result can be derived from them, so that a full build reads the price table once per shared aggregate
instead of once per mart. ``gondola.plans.build`` wires them together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import filled, mean, null_safe_join, nulls_last
from gondola.operators.aggregates import median_price, product_statistics, products_at_places, spread_columns, times
from gondola.operators.variation import against_previous_date
from gondola.schemas import (
    BANNER_KEY,
    BRANCH_KEY,
    COMPARABLE_PRODUCT,
    DATE,
    PRICE,
    PRODUCT_KEY,
    REFERENCE_PRICE,
)

# Basket categories in matching order.
BASKET_KEYWORDS = ("LECHE", "ARROZ", "FIDEO", "YERBA", "ACEITE", "AZUCAR", "HARINA", "HUEVO")

# Limits of the quality rules and of the dispersion mart.
LOW_PRICE = 10
HIGH_PRICE = 100_000
MIN_DISPERSION_ROWS = 20

_EVOLUTION = [
    DATE,
    *COMPARABLE_PRODUCT,
    "cantidad_registros",
    "precio_minimo",
    "precio_maximo",
    "precio_promedio",
    "precio_referencia_promedio",
]


def resumen_general(activity: DataFrame, by_banner: DataFrame, places: DataFrame) -> DataFrame:
    """Coverage and average price per date."""
    located = activity.join(places, BRANCH_KEY, "left")
    banner, branch = F.struct("id_comercio", "id_bandera"), F.struct("id_comercio", "id_bandera", "id_sucursal")
    coverage = located.groupBy(DATE).agg(
        F.sum(times("filas")).alias("cantidad_registros_precios"),
        F.count_distinct("id_comercio").alias("cantidad_comercios"),
        F.count_distinct(banner).alias("cantidad_banderas"),
        F.count_distinct(branch).alias("cantidad_sucursales"),
        F.count_distinct("sucursales_provincia").alias("cantidad_provincias"),
        F.count_distinct("sucursales_localidad").alias("cantidad_localidades"),
        mean(F.sum(times("suma_precio")), F.sum(times("filas_con_precio"))).alias("precio_promedio_general"),
    )
    return null_safe_join(coverage, products_per_date(by_banner), [DATE], "inner").select(
        DATE,
        "cantidad_registros_precios",
        "cantidad_productos_unicos",
        "cantidad_comercios",
        "cantidad_banderas",
        "cantidad_sucursales",
        "cantidad_provincias",
        "cantidad_localidades",
        "precio_promedio_general",
    )


def products_per_date(by_banner: DataFrame) -> DataFrame:
    """Distinct products per date, priced or not."""
    return by_banner.groupBy(DATE).agg(F.count_distinct("id_producto").alias("cantidad_productos_unicos"))


def productos_comparables(comparables: DataFrame) -> DataFrame:
    """Price statistics and spread per date and comparable product."""
    return comparables.select(*_EVOLUTION, *spread_columns())


def evolucion_productos(comparables: DataFrame) -> DataFrame:
    """Price statistics per date and comparable product."""
    return comparables.select(*_EVOLUTION)


def variacion_productos(evolution: DataFrame) -> DataFrame:
    """Average price against the product's latest earlier date."""
    return against_previous_date(evolution)


def resumen_productos(
    comparables: DataFrame, by_banner: DataFrame, prices: DataFrame, null_ids_count: bool = True
) -> DataFrame:
    """Coverage, range, average, approximate median and spread per date and product."""
    return product_statistics(comparables, by_banner, null_ids_count, median_price(prices)).select(
        *PRODUCT_KEY,
        "productos_descripcion",
        "productos_marca",
        "cantidad_registros",
        "cantidad_comercios",
        "cantidad_sucursales",
        "precio_minimo",
        "precio_maximo",
        "precio_promedio",
        "precio_mediano_aproximado",
        "diferencia_absoluta_max_min",
        "diferencia_porcentual_max_min",
    )


def productos_mayor_dispersion(
    comparables: DataFrame,
    by_banner: DataFrame,
    min_rows: int = MIN_DISPERSION_ROWS,
    null_ids_count: bool = True,
) -> DataFrame:
    """Products with enough rows to judge their price spread."""
    stats = product_statistics(comparables, by_banner, null_ids_count)
    return stats.where(F.col("cantidad_registros") >= min_rows).select(
        *PRODUCT_KEY,
        "productos_descripcion",
        "productos_marca",
        "cantidad_registros",
        "cantidad_comercios",
        "cantidad_sucursales",
        "precio_minimo",
        "precio_maximo",
        "precio_promedio",
        "diferencia_absoluta_max_min",
        "diferencia_porcentual_max_min",
    )


def precios_por_comercio(
    activity: DataFrame, by_banner: DataFrame, names: DataFrame, null_ids_count: bool = True
) -> DataFrame:
    """Activity and price range per date and banner."""
    priced = F.col("filas_con_precio") > 0
    branch = F.lit(1) if null_ids_count else F.concat("id_comercio", "id_bandera", "id_sucursal")
    ranges = (
        activity.where(priced)
        .groupBy(*BANNER_KEY)
        .agg(
            F.sum("filas_con_precio").alias("filas"),
            F.count(branch).alias("cantidad_sucursales"),
            mean(F.sum("suma_precio"), F.sum("filas_con_precio")).alias("precio_promedio"),
            F.min("precio_minimo").alias("precio_minimo"),
            F.max("precio_maximo").alias("precio_maximo"),
        )
    )
    products = by_banner.where(priced).groupBy(*BANNER_KEY).agg(F.count("id_producto").alias("cantidad_productos"))
    return (
        null_safe_join(ranges, products, BANNER_KEY, "inner")
        .join(names, BANNER_KEY, "left")
        .select(
            *BANNER_KEY,
            "comercio_bandera_nombre",
            times("filas").alias("cantidad_registros"),
            "cantidad_productos",
            "cantidad_sucursales",
            "precio_promedio",
            "precio_minimo",
            "precio_maximo",
        )
    )


def precios_por_ubicacion(
    activity: DataFrame, branches: DataFrame, places: DataFrame, null_ids_count: bool = True
) -> DataFrame:
    """Activity and average price per date and location; unmatched branches form the NULL location."""
    location = [DATE, "sucursales_provincia", "sucursales_localidad"]
    branch = F.struct("id_comercio", "id_bandera", "id_sucursal")
    if not null_ids_count:
        branch = F.when(F.concat(*[F.col(c) for c in BRANCH_KEY[1:]]).isNotNull(), branch)
    totals = (
        activity.where(F.col("filas_con_precio") > 0)
        .join(places, BRANCH_KEY, "left")
        .groupBy(*location)
        .agg(
            F.sum(times("filas_con_precio")).alias("cantidad_registros"),
            F.count_distinct("id_comercio").alias("cantidad_comercios"),
            F.count_distinct(branch).alias("cantidad_sucursales"),
            mean(F.sum(times("suma_precio")), F.sum(times("filas_con_precio"))).alias("precio_promedio"),
        )
    )
    products = products_at_places(branches, places).groupBy(*location).agg(F.count_distinct("id_producto").alias("cantidad_productos"))
    return null_safe_join(totals, products, location, "inner").select(
        *location,
        "cantidad_registros",
        "cantidad_productos",
        "cantidad_comercios",
        "cantidad_sucursales",
        "precio_promedio",
    )


def promociones(prices: DataFrame) -> DataFrame:
    """Promotional prices and legends per date and product.

    Rows are first reduced to one per product text and legend pair with a plain hash aggregation, so
    the list of distinct legends is built from few rows.
    """
    promo = ["productos_precio_unitario_promo1", "productos_precio_unitario_promo2"]
    legends = ["productos_leyenda_promo1", "productos_leyenda_promo2"]
    measures = {"lista": PRICE, "promo1": promo[0], "promo2": promo[1]}

    by_legend = (
        prices.where(
            F.col(promo[0]).isNotNull() | F.col(promo[1]).isNotNull() | filled(legends[0]) | filled(legends[1])
        )
        .groupBy(*PRODUCT_KEY, "productos_descripcion", "productos_marca", *legends)
        .agg(
            *[F.count(column).alias(f"n_{name}") for name, column in measures.items()],
            *[F.sum(column).alias(f"suma_{name}") for name, column in measures.items()],
        )
    )

    def distinct_legends(column: str) -> Column:
        values = F.array_sort(F.collect_set(F.nullif(F.col(column), F.lit(""))))
        return F.nullif(F.array_join(values, " | "), F.lit(""))

    return by_legend.groupBy(*PRODUCT_KEY).agg(
        F.min("productos_descripcion").alias("productos_descripcion"),
        F.min("productos_marca").alias("productos_marca"),
        F.sum("n_promo1").alias("cantidad_registros_con_promo1"),
        F.sum("n_promo2").alias("cantidad_registros_con_promo2"),
        distinct_legends(legends[0]).alias("ejemplos_leyendas_promo1"),
        distinct_legends(legends[1]).alias("ejemplos_leyendas_promo2"),
        *[mean(F.sum(f"suma_{m}"), F.sum(f"n_{m}")).alias(f"precio_promedio_{m}") for m in measures],
    )


def sucursales_geografia(branches: DataFrame, chains: DataFrame) -> DataFrame:
    """Branches with both coordinates and the name of their banner."""
    names = chains.select(*BANNER_KEY, "comercio_bandera_nombre")
    return (
        branches.where(F.col("sucursales_latitud").isNotNull() & F.col("sucursales_longitud").isNotNull())
        .join(names, BANNER_KEY, "left")
        .select(
            *BANNER_KEY,
            "comercio_bandera_nombre",
            "id_sucursal",
            "sucursales_nombre",
            "sucursales_tipo",
            "sucursales_calle",
            "sucursales_numero",
            "sucursales_localidad",
            "sucursales_provincia",
            "sucursales_latitud",
            "sucursales_longitud",
        )
    )


def calidad_precios(activity: DataFrame) -> DataFrame:
    """Missing, zero and very low prices per date; negative prices are in none of the buckets."""
    return activity.groupBy(DATE).agg(
        F.sum("filas").alias("cantidad_registros"),
        F.sum(F.col("filas") - F.col("filas_con_precio")).alias("cantidad_precio_nulo"),
        F.sum("filas_precio_cero").alias("cantidad_precio_cero"),
        F.sum("filas_precio_menor_10").alias("cantidad_precio_menor_10"),
        F.min("precio_minimo").alias("precio_minimo"),
        F.max("precio_maximo").alias("precio_maximo"),
        mean(F.sum("suma_precio"), F.sum("filas_con_precio")).alias("precio_promedio"),
    )


def precios_sospechosos(prices: DataFrame) -> DataFrame:
    """Every price row that breaks a quality rule, labelled: a filter of one scan, stored by date."""
    price = F.col(PRICE)
    columns = [DATE, *COMPARABLE_PRODUCT, PRICE, REFERENCE_PRICE]
    return prices.where((price < LOW_PRICE) | (price >= HIGH_PRICE)).select(
        *columns,
        F.when(price <= 0, "precio_menor_o_igual_cero")
        .when(price < LOW_PRICE, "precio_menor_10")
        .otherwise("precio_muy_alto")
        .alias("regla_calidad"),
    )


def basket_category(keywords: Sequence[str] = BASKET_KEYWORDS) -> Column:
    """The first keyword contained in the description, ignoring case."""
    category = F.lit(None).cast("string")
    for word in reversed(keywords):
        category = F.when(F.col("productos_descripcion").ilike(f"%{word}%"), word).otherwise(category)
    return category


def canasta_basica_candidatos(evolution: DataFrame, keywords: Sequence[str] = BASKET_KEYWORDS) -> DataFrame:
    """Comparable products whose description names a basket category.

    The description is part of the comparable product, so the category can be attached after the
    aggregation, to far fewer rows.
    """
    return evolution.withColumn("categoria_canasta", basket_category(keywords)).where(
        F.col("categoria_canasta").isNotNull()
    ).select(
        DATE,
        "categoria_canasta",
        *COMPARABLE_PRODUCT,
        "cantidad_registros",
        "precio_minimo",
        "precio_maximo",
        "precio_promedio",
        "precio_referencia_promedio",
    )
