"""Data contract: raw file layouts, base tables and logical keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column order of the three published files (headers are compared for equality).
COMERCIO_HEADER = (
    "id_comercio",
    "id_bandera",
    "comercio_cuit",
    "comercio_razon_social",
    "comercio_bandera_nombre",
    "comercio_bandera_url",
    "comercio_ultima_actualizacion",
    "comercio_version_sepa",
)

SUCURSALES_HEADER = (
    "id_comercio",
    "id_bandera",
    "id_sucursal",
    "sucursales_nombre",
    "sucursales_tipo",
    "sucursales_calle",
    "sucursales_numero",
    "sucursales_latitud",
    "sucursales_longitud",
    "sucursales_observaciones",
    "sucursales_barrio",
    "sucursales_codigo_postal",
    "sucursales_localidad",
    "sucursales_provincia",
    "sucursales_lunes_horario_atencion",
    "sucursales_martes_horario_atencion",
    "sucursales_miercoles_horario_atencion",
    "sucursales_jueves_horario_atencion",
    "sucursales_viernes_horario_atencion",
    "sucursales_sabado_horario_atencion",
    "sucursales_domingo_horario_atencion",
)

PRODUCTOS_HEADER = (
    "id_comercio",
    "id_bandera",
    "id_sucursal",
    "id_producto",
    "productos_ean",
    "productos_descripcion",
    "productos_cantidad_presentacion",
    "productos_unidad_medida_presentacion",
    "productos_marca",
    "productos_precio_lista",
    "productos_precio_referencia",
    "productos_cantidad_referencia",
    "productos_unidad_medida_referencia",
    "productos_precio_unitario_promo1",
    "productos_leyenda_promo1",
    "productos_precio_unitario_promo2",
    "productos_leyenda_promo2",
)

DATE = "fecha_publicacion"
PRICE = "productos_precio_lista"
REFERENCE_PRICE = "productos_precio_referencia"

BANNER_KEY = [DATE, "id_comercio", "id_bandera"]
BRANCH_KEY = [*BANNER_KEY, "id_sucursal"]
PRODUCT_KEY = [DATE, "id_producto"]
#: Two rows describe the same product only when all five agree (NULL equals NULL).
COMPARABLE_PRODUCT = [
    "id_producto",
    "productos_descripcion",
    "productos_marca",
    "productos_cantidad_presentacion",
    "productos_unidad_medida_presentacion",
]


@dataclass(frozen=True)
class TableSpec:
    """How one published file becomes one base table."""

    table: str
    csv: str
    header: tuple[str, ...]
    output: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, self._type(name)) for name in self.output])

    def _type(self, name: str) -> T.DataType:
        if name == DATE:
            return T.DateType()
        if name in self.numeric:
            return T.DoubleType()
        if name in self.timestamps:
            return T.TimestampType()
        return T.StringType()


# Notes and opening hours are published but not kept.
_DROPPED = {c for c in SUCURSALES_HEADER if c.endswith(("_observaciones", "_horario_atencion"))}

#: Declaration order is the order in which the files of one member are read.
TABLES: dict[str, TableSpec] = {
    spec.table: spec
    for spec in (
        TableSpec(
            table="dim_comercios",
            csv="comercio.csv",
            header=COMERCIO_HEADER,
            output=(*COMERCIO_HEADER, DATE, "archivo_origen"),
            timestamps=("comercio_ultima_actualizacion",),
        ),
        TableSpec(
            table="dim_sucursales",
            csv="sucursales.csv",
            header=SUCURSALES_HEADER,
            output=(*(c for c in SUCURSALES_HEADER if c not in _DROPPED), DATE, "archivo_origen"),
            numeric=("sucursales_latitud", "sucursales_longitud"),
        ),
        TableSpec(
            table="fact_precios",
            csv="productos.csv",
            header=PRODUCTOS_HEADER,
            output=(DATE, *PRODUCTOS_HEADER, "archivo_origen"),
            numeric=(
                "productos_cantidad_presentacion",
                PRICE,
                REFERENCE_PRICE,
                "productos_cantidad_referencia",
                "productos_precio_unitario_promo1",
                "productos_precio_unitario_promo2",
            ),
        ),
    )
}

FACT, CHAINS, BRANCHES = "fact_precios", "dim_comercios", "dim_sucursales"

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("id_ingesta", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("zip_path", T.StringType()),
        T.StructField("zip_filename", T.StringType()),
        T.StructField("fechas_publicacion", T.StringType()),
        T.StructField("modo_carga", T.StringType()),
        T.StructField("estado", T.StringType()),
        T.StructField("filas_dim_comercios", T.LongType()),
        T.StructField("filas_dim_sucursales", T.LongType()),
        T.StructField("filas_fact_precios", T.LongType()),
        T.StructField("errores", T.IntegerType()),
        T.StructField("detalle", T.StringType()),
    ]
)

RESOURCE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("id", "name", "format", "url", "created", "metadata_modified", "last_modified")
    ]
)


@dataclass(frozen=True)
class BaseTables:
    """The star schema the marts and finders read."""

    precios: DataFrame
    comercios: DataFrame
    sucursales: DataFrame
