"""Result shaping for people: rounding, labels and number formats as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column labels.
LABELS = {
    "fecha_publicacion": "Fecha",
    "id_producto": "ID producto",
    "productos_descripcion": "Producto",
    "productos_marca": "Marca",
    "productos_cantidad_presentacion": "Presentación",
    "productos_unidad_medida_presentacion": "Unidad",
    "productos_precio_lista": "Precio lista",
    "productos_precio_referencia": "Precio referencia",
    "precio_minimo": "Precio mínimo",
    "precio_maximo": "Precio máximo",
    "precio_promedio": "Precio promedio",
    "precio_mediano_aproximado": "Precio mediano aprox.",
    "precio_referencia_promedio": "Precio ref. promedio",
    "precio_promedio_general": "Precio promedio general",
    "precio_promedio_lista": "Precio promedio lista",
    "precio_promedio_promo1": "Precio promo 1",
    "precio_promedio_promo2": "Precio promo 2",
    "precio_promedio_anterior": "Precio promedio anterior",
    "precio_promedio_actual": "Precio promedio actual",
    "cantidad_registros": "Registros",
    "cantidad_registros_actual": "Registros actuales",
    "cantidad_registros_anterior": "Registros anteriores",
    "cantidad_registros_precios": "Registros de precios",
    "cantidad_productos": "Productos",
    "cantidad_productos_unicos": "Productos únicos",
    "cantidad_sucursales": "Sucursales",
    "cantidad_comercios": "Comercios",
    "cantidad_banderas": "Banderas",
    "cantidad_provincias": "Provincias",
    "cantidad_localidades": "Localidades",
    "cantidad_precio_cero": "Precios cero",
    "cantidad_precio_menor_10": "Precios menores a 10",
    "cantidad_registros_con_promo1": "Registros promo 1",
    "cantidad_registros_con_promo2": "Registros promo 2",
    "categoria_canasta": "Categoría",
    "variacion_absoluta": "Variación absoluta",
    "variacion_porcentual": "Variación %",
    "diferencia_absoluta_max_min": "Diferencia absoluta",
    "diferencia_porcentual_max_min": "Diferencia %",
    "comercio_bandera_nombre": "Comercio",
    "sucursales_nombre": "Sucursal",
    "sucursales_localidad": "Localidad",
    "sucursales_provincia": "Provincia",
    "sucursales_latitud": "Latitud",
    "sucursales_longitud": "Longitud",
    "regla_calidad": "Regla de calidad",
    "fechas_disponibles": "Fechas disponibles",
    "registros_totales": "Registros totales",
}

# Columns shown with two decimals.
ROUNDED = {
    "precio_minimo",
    "precio_maximo",
    "precio_promedio",
    "precio_mediano_aproximado",
    "precio_referencia_promedio",
    "precio_promedio_general",
    "precio_promedio_lista",
    "precio_promedio_promo1",
    "precio_promedio_promo2",
    "precio_promedio_anterior",
    "precio_promedio_actual",
    "productos_precio_lista",
    "productos_precio_referencia",
    "variacion_absoluta",
    "diferencia_absoluta_max_min",
    "variacion_porcentual",
    "diferencia_porcentual_max_min",
}

# What stands for a missing value or brand, label length and number of charted rows.
NOTHING = "-"
NO_BRAND = "S/M"
LABEL_LENGTH = 58
CHART_ROWS = 20


def for_display(frame: DataFrame) -> DataFrame:
    """Round price and percent columns and give known columns their labels, in one projection.

    ``bround`` rounds exact halves to the even digit.
    """
    return frame.select(
        *[
            (F.bround(F.col(c).try_cast("double"), 2) if c in ROUNDED else F.col(c)).alias(LABELS.get(c, c))
            for c in frame.columns
        ]
    )


def with_labels(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed({c: LABELS[c] for c in frame.columns if c in LABELS})


def integer_text(value: Column) -> Column:
    """``1.234.567``; decimals are cut off."""
    return F.coalesce(F.translate(F.format_number(value.cast("bigint"), 0), ",", "."), F.lit(NOTHING))


def _two_decimals(value: Column) -> Column:
    return F.translate(F.format_number(value.cast("double"), 2), ",.", ".,")


def currency_text(value: Column) -> Column:
    """``$1.234,56``."""
    return F.coalesce(F.concat(F.lit("$"), _two_decimals(value)), F.lit(NOTHING))


def percentage_text(value: Column) -> Column:
    """``1.234,56%``."""
    return F.coalesce(F.concat(_two_decimals(value), F.lit("%")), F.lit(NOTHING))


def _brand() -> Column:
    return F.coalesce("productos_marca", F.lit(NO_BRAND))


def chart_rows(ranking: DataFrame, order: list[Column], limit: int = CHART_ROWS) -> DataFrame:
    """The first rows of a ranking with a short product label."""
    label = F.concat(
        F.substring(F.coalesce("productos_descripcion", F.lit("")), 1, LABEL_LENGTH), F.lit(" | "), _brand()
    )
    return ranking.orderBy(*order).limit(limit).withColumn("producto", label)


def candidate_option(candidates: DataFrame) -> DataFrame:
    """One line of text per product candidate, for a selection list."""
    quantity = F.coalesce(F.col("productos_cantidad_presentacion").cast("string"), F.lit("nan"))
    return candidates.withColumn(
        "opcion",
        F.concat(
            F.coalesce("productos_descripcion", F.lit("")),
            F.lit(" | "),
            _brand(),
            F.lit(" | "),
            quantity,
            F.lit(" "),
            F.coalesce("productos_unidad_medida_presentacion", F.lit("")),
            F.lit(" | fechas: "),
            F.col("fechas_disponibles").cast("string"),
        ),
    )


def ranked_bars(chart: DataFrame, measure: str) -> DataFrame:
    """Bars of a horizontal chart, smallest first."""
    return chart.orderBy(F.col(measure).asc_nulls_last())
