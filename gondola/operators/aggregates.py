"""Aggregates of the price table that several marts share.

Each is one ``groupBy`` with map-side partial aggregation, so a product, chain or branch that holds a
large part of all rows is reduced before the shuffle and never lands in one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import percent_change
from gondola.schemas import BANNER_KEY, BRANCH_KEY, COMPARABLE_PRODUCT, DATE, PRICE, PRODUCT_KEY, REFERENCE_PRICE


def branch_activity(prices: DataFrame) -> DataFrame:
    """One row per date and branch: everything the marts need that does not depend on the product."""
    price = F.col(PRICE)
    return prices.groupBy(*BRANCH_KEY).agg(
        F.count("*").alias("filas"),
        F.count(price).alias("filas_con_precio"),
        F.sum(price).alias("suma_precio"),
        F.min(price).alias("precio_minimo"),
        F.max(price).alias("precio_maximo"),
        F.count_if(price == 0).alias("filas_precio_cero"),
        F.count_if((price > 0) & (price < 10)).alias("filas_precio_menor_10"),
    )


def branch_bit(branch: str = "id_sucursal") -> tuple[Column, Column, Column]:
    """Where a branch id stands in the bit sets of its banner: number of the long, text of an id without a number, bit.

    Branch ids are small numbers within a banner, so 64 neighbours share a long. An id that is no plain number is
    a set of its own; NULL has neither number nor text.
    """
    number = F.col(branch).try_cast("long")
    plain = F.coalesce((number >= 0) & (number.cast("string") == F.col(branch)), F.lit(False))
    bit = F.expr(f"shiftleft(1L, cast(pmod(try_cast({branch} as long), 64) as int))")
    return (
        F.when(plain, F.expr(f"try_cast({branch} as long) div 64")),
        F.when(~plain, F.col(branch)),
        F.when(plain, bit).when(F.col(branch).isNotNull(), F.lit(1).cast("long")),
    )


def product_branches(prices: DataFrame) -> DataFrame:
    """Where a product is sold: per date, banner and product the branches with prices, as bit sets.

    Map tasks combine the bits by OR before anything is shuffled: no raw price moves, and a product with very many
    prices is as many rows as it has longs in a map task. ``bits`` is NULL in rows without a priced, known branch.
    """
    word, other, bit = branch_bit()
    priced = F.col(PRICE).isNotNull()
    keys = [*BANNER_KEY, "id_producto"]
    bits = prices.select(*keys, word.alias("palabra"), other.alias("otra"), F.when(priced, bit).alias("bit"), priced.cast("long").alias("con_precio"))
    return bits.groupBy(*keys, "palabra", "otra").agg(F.sum("con_precio").alias("filas_con_precio"), F.bit_or("bit").alias("bits"))


def product_by_banner(branches: DataFrame) -> DataFrame:
    """One row per date, banner and product, from :func:`product_branches`.

    Branches belong to one banner, so the distinct branches of a product are the sum of its distinct
    branches over banners. Branches are counted without NULL ids; ``sucursal_nula`` tells whether
    a NULL id occurred, so both counting rules can be derived.
    """
    no_branch = F.col("palabra").isNull() & F.col("otra").isNull()
    return branches.groupBy(*BANNER_KEY, "id_producto").agg(
        F.sum("filas_con_precio").alias("filas_con_precio"),
        F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("sucursales"),
        F.max(F.when(no_branch & (F.col("filas_con_precio") > 0), 1).otherwise(0)).alias("sucursal_nula"),
    )


def products_at_places(branches: DataFrame, places: DataFrame) -> DataFrame:
    """Date, location and product where a product has a price at a branch of the location; NULL location for branches without one.

    The branches of each location are bit sets too, so a product's set meets all locations of its branches in one row
    and single prices are joined to nothing.
    """
    word, other, bit = branch_bit()
    location = ["sucursales_provincia", "sucursales_localidad"]
    # Neither a NULL id nor a NULL part of the key meets a place.
    key = F.coalesce(F.col("palabra").cast("string"), F.concat(F.lit("="), "otra"))
    sets = places.select(*BANNER_KEY, word.alias("palabra"), other.alias("otra"), bit.alias("bit"), *location)
    sets = sets.groupBy(*BANNER_KEY, key.alias("conjunto"), *location).agg(F.bit_or("bit").alias("en_lugar"))
    sets = sets.groupBy(*BANNER_KEY, "conjunto").agg(
        F.bit_or("en_lugar").alias("en_alguno"), F.collect_list(F.struct("en_lugar", *location)).alias("lugares")
    )
    priced = branches.where(F.col("filas_con_precio") > 0).select(*BANNER_KEY, "id_producto", key.alias("conjunto"), "bits")
    met = priced.join(sets, [*BANNER_KEY, "conjunto"], "left")
    here = F.filter("lugares", lambda place: place["en_lugar"].bitwiseAND(F.col("bits")) != 0)
    nowhere = F.col("en_alguno").isNull() | (F.col("bits").bitwiseAND(F.bitwise_not("en_alguno")) != 0)
    none = F.array(F.struct(F.lit(None).cast("long").alias("en_lugar"), *[F.lit(None).cast("string").alias(c) for c in location]))
    found = F.concat(F.coalesce(here, F.slice(none, 1, 0)), F.when(nowhere, none).otherwise(F.slice(none, 1, 0)))
    return met.select(DATE, "id_producto", F.explode(found).alias("lugar")).select(DATE, *[f"lugar.{c}" for c in location], "id_producto")


def branch_places(branches: DataFrame) -> DataFrame:
    """Locations of every branch key, with the number of dimension rows behind each.

    The branch dimension is not unique per key; a join multiplies price rows by the matching
    dimension rows. Carrying that multiplicity as a weight lets the facts be aggregated before the
    join and still give the joined counts.
    """
    return branches.groupBy(*BRANCH_KEY, "sucursales_provincia", "sucursales_localidad").agg(
        F.count("*").alias("veces")
    )


def banner_names(chains: DataFrame) -> DataFrame:
    """Name and multiplicity of every banner key (the chain dimension is not unique either)."""
    return chains.groupBy(*BANNER_KEY).agg(
        F.min("comercio_bandera_nombre").alias("comercio_bandera_nombre"),
        F.count("*").alias("veces"),
    )


def times(column: str) -> Column:
    """A count or sum weighted by the dimension multiplicity; unmatched rows count once."""
    return F.col(column) * F.coalesce(F.col("veces"), F.lit(1))


def spread_columns() -> list[Column]:
    low, high = F.col("precio_minimo"), F.col("precio_maximo")
    return [
        (high - low).alias("diferencia_absoluta_max_min"),
        percent_change(high, low).alias("diferencia_porcentual_max_min"),
    ]


def comparable_products(prices: DataFrame) -> DataFrame:
    """Price statistics per date and comparable product, from the priced rows.

    ``suma_precio`` lets averages be rolled up further. Texts are keys here and never aggregated: a
    MIN over text would turn the hash aggregation of all prices into a sort.
    """
    price = F.col(PRICE)
    return (
        prices.where(price.isNotNull())
        .groupBy(DATE, *COMPARABLE_PRODUCT)
        .agg(
            F.count("*").alias("cantidad_registros"),
            F.min(price).alias("precio_minimo"),
            F.max(price).alias("precio_maximo"),
            F.sum(price).alias("suma_precio"),
            F.avg(REFERENCE_PRICE).alias("precio_referencia_promedio"),
        )
        .withColumn("precio_promedio", F.col("suma_precio") / F.col("cantidad_registros"))
    )


def product_statistics(
    comparables: DataFrame, by_banner: DataFrame, null_ids_count: bool = True, median: DataFrame | None = None
) -> DataFrame:
    """Coverage, range, spread and, where given, the median per date and product.

    What comes from :func:`comparable_products`, :func:`product_by_banner` and :func:`median_price` are
    different columns of the same products, so their rows are put under one another and aggregated once:
    NULL keys meet without a join. ``null_ids_count`` chooses how a branch key with a NULL part is counted: as
    a branch of its own (marts) or not at all (saved queries, which concatenate the key).
    """
    branches = F.col("sucursales") + F.col("sucursal_nula")
    if not null_ids_count:
        branches = F.when(F.col("id_comercio").isNotNull() & F.col("id_bandera").isNotNull(), F.col("sucursales"))
    ranges = comparables.select(
        *PRODUCT_KEY,
        "productos_descripcion",
        "productos_marca",
        "cantidad_registros",
        "precio_minimo",
        "precio_maximo",
        "suma_precio",
    )
    coverage = by_banner.where(F.col("filas_con_precio") > 0).select(
        *PRODUCT_KEY, "id_comercio", branches.alias("cantidad_sucursales")
    )
    parts = ranges.unionByName(coverage, allowMissingColumns=True)
    if median is not None:
        parts = parts.unionByName(median, allowMissingColumns=True)
    stats = parts.groupBy(*PRODUCT_KEY).agg(
        F.min("productos_descripcion").alias("productos_descripcion"),
        F.min("productos_marca").alias("productos_marca"),
        F.sum("cantidad_registros").alias("cantidad_registros"),
        F.min("precio_minimo").alias("precio_minimo"),
        F.max("precio_maximo").alias("precio_maximo"),
        (F.sum("suma_precio") / F.sum("cantidad_registros")).alias("precio_promedio"),
        F.count_distinct("id_comercio").alias("cantidad_comercios"),
        F.coalesce(F.sum("cantidad_sucursales"), F.lit(0)).alias("cantidad_sucursales"),
        *([F.max("precio_mediano_aproximado").alias("precio_mediano_aproximado")] if median is not None else []),
    )
    return stats.select("*", *spread_columns())


def median_price(prices: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Approximate median per date and product; the sketch has bounded size whatever the group holds."""
    return (
        prices.where(F.col(PRICE).isNotNull())
        .groupBy(*PRODUCT_KEY)
        .agg(F.percentile_approx(PRICE, 0.5, accuracy).alias("precio_mediano_aproximado"))
    )
