"""The star schema and resource metadata as views over the given tables.

The same SELECT text runs in Spark and in the checking database; ``{table}`` stands for a source table. Missing, zero and very low prices,
branches absent from the dimension and dimension rows listed twice are part of the views.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

SOURCES = ("region", "nation", "supplier", "part", "lineitem", "orders")

_YEAR = "cast(date_trunc('year', l_shipdate) as date)"

FACT_PRECIOS = f"""
select {_YEAR} as fecha_publicacion,
       cast(n_regionkey as varchar(20)) as id_comercio,
       cast(s_nationkey as varchar(20)) as id_bandera,
       cast(l_suppkey as varchar(20)) as id_sucursal,
       p_brand || '/' || p_type as id_producto,
       p_name as productos_descripcion,
       case when p_size > 1 then p_brand end as productos_marca,
       cast(p_size as double) as productos_cantidad_presentacion,
       p_type as productos_unidad_medida_presentacion,
       case when l_quantity = 1 then null
            when l_quantity = 2 then cast(0 as double)
            when l_quantity = 3 then cast(5 as double)
            else l_extendedprice end as productos_precio_lista,
       p_retailprice as productos_precio_referencia,
       case when l_discount >= 0.04 then l_extendedprice * (1 - l_discount) end as productos_precio_unitario_promo1,
       case when l_discount >= 0.04 then l_returnflag else '' end as productos_leyenda_promo1,
       case when l_tax >= 0.07 then l_extendedprice * (1 - l_tax) end as productos_precio_unitario_promo2,
       case when l_tax >= 0.07 then l_linestatus else '' end as productos_leyenda_promo2
from {{lineitem}}
join {{part}} on l_partkey = p_partkey
join {{supplier}} on l_suppkey = s_suppkey
join {{nation}} on s_nationkey = n_nationkey
"""

# A chain lists its banners on every date it publishes; some names are listed twice.
DIM_COMERCIOS = f"""
select fecha_publicacion, id_comercio, id_bandera, comercio_bandera_nombre
from (
    select distinct {_YEAR} as fecha_publicacion,
           cast(n_regionkey as varchar(20)) as id_comercio,
           cast(n_nationkey as varchar(20)) as id_bandera,
           n_name as comercio_bandera_nombre
    from {{lineitem}} join {{supplier}} on l_suppkey = s_suppkey join {{nation}} on s_nationkey = n_nationkey
) listados
union all
select distinct {_YEAR}, cast(n_regionkey as varchar(20)), cast(n_nationkey as varchar(20)), n_name || ' (BIS)'
from {{lineitem}} join {{supplier}} on l_suppkey = s_suppkey join {{nation}} on s_nationkey = n_nationkey
where n_name < 'D'
"""

# Branches with a negative balance are closed: they have prices but no dimension row.
# Those with a high balance are listed a second time at another location.
DIM_SUCURSALES = f"""
select fecha_publicacion,
       cast(n_regionkey as varchar(20)) as id_comercio,
       cast(s_nationkey as varchar(20)) as id_bandera,
       cast(s_suppkey as varchar(20)) as id_sucursal,
       s_name as sucursales_nombre,
       cast('Sucursal' as varchar(20)) as sucursales_tipo,
       cast(s_suppkey as varchar(20)) || ' St' as sucursales_calle,
       cast(s_suppkey as varchar(20)) as sucursales_numero,
       case when copia = 1 then n_name else n_name || ' ANEXO' end as sucursales_localidad,
       r_name as sucursales_provincia,
       case when s_acctbal < 7000 then s_acctbal / 100 end as sucursales_latitud,
       s_acctbal / 200 as sucursales_longitud
from (
    select distinct {_YEAR} as fecha_publicacion, l_suppkey as sucursal, 1 as copia from {{lineitem}}
    union all
    select distinct {_YEAR}, l_suppkey, 2 from {{lineitem}}
) publicadas
join {{supplier}} on sucursal = s_suppkey
join {{nation}} on s_nationkey = n_nationkey
join {{region}} on n_regionkey = r_regionkey
where s_acctbal >= 0 and (copia = 1 or s_acctbal > 8000)
"""

_ORDER_DAY = "cast(cast(o_orderdate as date) as varchar(20))"

# Every order describes one published resource: dates sit in the name, in the URL or only in the metadata.
RECURSOS = f"""
select cast(o_orderkey as int) as posicion,
       cast(o_orderkey as varchar(20)) as id,
       case when o_orderpriority = '5-LOW' then null
            when o_orderpriority = '1-URGENT' then 'Precios ' || {_ORDER_DAY}
            when o_orderpriority = '2-HIGH' then 'precios_' || {_ORDER_DAY}
            else 'Precios diarios' end as name,
       case when o_orderpriority = '5-LOW' then 'Publicado ' || {_ORDER_DAY} end as description,
       case when o_orderstatus = 'F' then 'ZIP' when o_orderstatus = 'O' then 'csv' end as format,
       case when o_totalprice < 20000 then ''
            when o_orderpriority = '3-MEDIUM' then 'https://datos.example/' || {_ORDER_DAY} || '/precios.ZIP'
            when o_totalprice < 200000 then 'https://datos.example/precios.csv'
            else 'https://datos.example/precios.zip' end as url,
       {_ORDER_DAY} || 'T08:00:00' as created,
       case when o_totalprice < 300000 then {_ORDER_DAY} || 'T12:30:00-03:00' end as metadata_modified,
       case when o_totalprice < 100000 then '' when o_totalprice < 150000 then 'ayer'
            when o_totalprice < 250000 then {_ORDER_DAY} || 'T23:15:00-03:00' end as last_modified
from {{orders}}
"""

STAR = {"fact_precios": FACT_PRECIOS, "dim_comercios": DIM_COMERCIOS, "dim_sucursales": DIM_SUCURSALES}


class Views:
    """The views over the Parquet tables of one folder; each table is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def select(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{name: self.table(name) for name in SOURCES if "{" + name + "}" in text})

    # The star schema, in the shape of ``gondola.schemas.BaseTables``; a query that reads prices only
    # does not open the dimensions.

    @cached_property
    def precios(self) -> DataFrame:
        return self.select(FACT_PRECIOS)

    @cached_property
    def comercios(self) -> DataFrame:
        return self.select(DIM_COMERCIOS)

    @cached_property
    def sucursales(self) -> DataFrame:
        return self.select(DIM_SUCURSALES)


def plain(text: str) -> str:
    """The SELECT over tables registered under their own names."""
    return text.format(**{name: name for name in SOURCES})


# Line items as published text rows: decimal commas, thousands dots, stray whitespace, letters,
# missing-value words, a blank row, a closing line and rows one field short.
TEXTOS = """
select l_orderkey, l_linenumber, l_suppkey,
       cast(l_linestatus as varchar(20)) as estado_linea,
       case when l_quantity = 1 then ''
            when l_quantity = 2 then 'Última Actualización: ' || cast(l_shipdate as varchar(40))
            when l_quantity = 3 then 'S' || cast(l_suppkey as varchar(20))
            when l_quantity = 4 then ' ' || cast(l_suppkey as varchar(20)) || chr(9)
            else cast(l_suppkey as varchar(20)) end as id,
       case when l_linenumber = 1 then replace(cast(l_extendedprice as varchar(30)), '.', ',')
            when l_linenumber = 2 then '1.' || replace(cast(l_extendedprice as varchar(30)), '.', ',')
            when l_linenumber = 3 then chr(9) || cast(l_extendedprice as varchar(30)) || ' '
            when l_linenumber = 4 then cast(l_extendedprice as varchar(30)) || 'd'
            when l_linenumber = 5 then 'nan'
            else cast(l_extendedprice as varchar(30)) end as numero,
       case when l_returnflag = 'A' then 'None'
            when l_returnflag = 'N' then '  ' || l_returnflag || chr(10)
            else l_returnflag end as texto,
       case when l_returnflag = 'R' then 'sin fecha'
            else cast(cast(l_shipdate as date) as varchar(20)) || 'T04:00:00-0300' end as momento
from {lineitem}
"""
