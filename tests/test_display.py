"""Number formats, labels and the dashboard queries that depend on NULL handling."""

import datetime

from pyspark.sql import functions as F

from gondola.functions import display
from gondola.plans import dashboard as d


def shown(spark, items, column):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x double")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("x"))).collect()]


def test_formats(spark):
    assert shown(spark, [1234567.9, 0.0, -1234.9, None], display.integer_text) == ["1.234.567", "0", "-1.234", "-"]
    assert shown(spark, [1234567.891, 0.5, None], display.currency_text) == ["$1.234.567,89", "$0,50", "-"]
    assert shown(spark, [-1234.5, None], display.percentage_text) == ["-1.234,50%", "-"]


def test_display_columns(spark):
    frame = spark.createDataFrame([(1.23456, "x", 7)], "precio_minimo double, otra string, cantidad_registros int")
    result = display.for_display(frame)
    assert result.columns == ["Precio mínimo", "otra", "Registros"]
    assert tuple(result.first()) == (1.23, "x", 7)
    assert display.with_labels(frame).columns == result.columns
    assert len(display.LABELS) == 48


def test_labels(spark):
    frame = spark.createDataFrame(
        [("d" * 80, None, 1.5, "kg", 3, 2.0), (None, "m", None, None, 1, 1.0)],
        "productos_descripcion string, productos_marca string, productos_cantidad_presentacion double, "
        "productos_unidad_medida_presentacion string, fechas_disponibles long, variacion_porcentual double",
    )
    rows = display.chart_rows(frame, [F.desc("variacion_porcentual")]).collect()
    assert [r["producto"] for r in rows] == ["d" * 58 + " | S/M", " | m"]
    options = [r["opcion"] for r in display.candidate_option(frame).collect()]
    assert options == ["d" * 80 + " | S/M | 1.5 kg | fechas: 3", " | m | nan  | fechas: 1"]
    bars = display.ranked_bars(frame, "variacion_porcentual").collect()
    assert [r["variacion_porcentual"] for r in bars] == [1.0, 2.0]


def test_series_matches_null_parts(spark):
    day = datetime.date
    rows = [
        (day(2026, 5, 20), "p", "d", None, None, "kg", 1, 10.0, 12.0, 0.0, None),
        (day(2026, 5, 21), "p", "d", None, None, "kg", 1, 10.0, 12.0, 11.0, None),
        (day(2026, 5, 21), "p", "d", "m", None, "kg", 1, 10.0, 12.0, 99.0, None),
    ]
    evolution = spark.createDataFrame(
        rows,
        "fecha_publicacion date, id_producto string, productos_descripcion string, productos_marca string, "
        "productos_cantidad_presentacion double, productos_unidad_medida_presentacion string, "
        "cantidad_registros long, precio_minimo double, precio_maximo double, precio_promedio double, "
        "precio_referencia_promedio double",
    )
    series = d.product_series(evolution, "p", "d", None, None, "kg")
    assert [r["precio_promedio"] for r in series.collect()] == [0.0, 11.0]
    change = d.series_change(series).first()
    # The base is zero: an absolute change, no percentage.
    assert (change["variacion_absoluta"], change["variacion_porcentual"]) == (11.0, None)
    assert d.series_by_metric(series).count() == 6
    assert d.series_change(series.where("false")).count() == 0
