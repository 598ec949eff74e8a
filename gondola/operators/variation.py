"""Change of a product's average price against its latest earlier publication date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.columns import percent_change
from gondola.schemas import COMPARABLE_PRODUCT, DATE


def against_previous_date(evolution: DataFrame) -> DataFrame:
    """As-of comparison on a frame with one row per date and comparable product.

    The previous available date is the previous row of the product, so ``lag`` over one shuffle
    replaces an inequality self-join. A window group holds at most one row per publication date
    because the input is already aggregated, however many prices a product has.
    Rows without a product id or date never match an earlier row.
    """
    history = Window.partitionBy(*COMPARABLE_PRODUCT).orderBy(DATE)
    now, before = F.col("precio_promedio"), F.col("precio_promedio_anterior")
    return (
        evolution.where(F.col("id_producto").isNotNull() & F.col(DATE).isNotNull())
        .select(
            DATE,
            F.lag(DATE).over(history).alias("fecha_anterior"),
            *COMPARABLE_PRODUCT,
            "precio_promedio",
            F.lag("precio_promedio").over(history).alias("precio_promedio_anterior"),
            "cantidad_registros",
            F.lag("cantidad_registros").over(history).alias("cantidad_registros_anterior"),
        )
        .where(F.col("fecha_anterior").isNotNull())
        .select(
            DATE,
            "fecha_anterior",
            *COMPARABLE_PRODUCT,
            now.alias("precio_promedio_actual"),
            before,
            (now - before).alias("variacion_absoluta"),
            percent_change(now, before).alias("variacion_porcentual"),
            F.col("cantidad_registros").alias("cantidad_registros_actual"),
            "cantidad_registros_anterior",
        )
    )
