"""Every operator as a named check: a Spark query over the given tables and, where SQL can say it, the
same result as SQL. All of them run over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import archives, views
from checks.folders import run_folder
from checks.reference_sql import MART_COLUMNS, NUDGE, P5, PRODUCT, asc, cols, compose, joined, saved_sql
from gondola.functions import cleaning, display
from gondola.operators import inspection
from gondola.plans import dashboard as d
from gondola.plans import ingest
from gondola.plans import saved_queries as q
from gondola.plans.build import MARTS, MartSources, build_marts
from gondola.plans.inspect import inspect_archives
from gondola.schemas import BRANCHES, CHAINS, DATE, FACT, TABLES
from gondola.session import configure
from gondola.sources import resources as k
from gondola.sources.nested_zip import HEADERS, INSPECT, LOAD, MEMBERS, read_archives, whole_members
from gondola.sources.pipe_files import read_sources
from gondola.sources.tables import Warehouse, export

# Parameters that fit the given tables: words of part names, shipping years, part brands and types.
KEYWORDS = ("RED", "RING", "WIDGET", "BOLT", "GEAR")
START, END = "1999-01-01", "2000-01-01"
TEXT, BRAND, UNIT = "ring", "Brand#12", "SMALL"
PROVINCE, LOCALITY = "MIDDLE EAST", "NATION_9"
MIN_ROWS = 3


class Context:
    """Lazily built inputs of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.views = views.Views(self.spark, sf_dir)

    @cached_property
    def sources(self) -> MartSources:
        return MartSources(self.views, KEYWORDS)

    def mart(self, name: str) -> DataFrame:
        return self.sources.mart("mart_" + name)

    @cached_property
    def resources(self) -> DataFrame:
        return self.views.select(views.RECURSOS)

    @cached_property
    def texts(self) -> DataFrame:
        return self.views.select(views.TEXTOS)

    @cached_property
    def archives(self) -> list[str]:
        return archives.archives(self.spark, self.sf_dir, self.views.select(views.FACT_PRECIOS))

    @cached_property
    def broken(self) -> list[str]:
        return archives.broken_archives(self.spark, self.views.select(views.FACT_PRECIOS))

    def scan_broken(self, mode: str) -> DataFrame:
        return read_archives(self.spark, self.broken, mode)

    def scan(self, mode: str = LOAD, csv: str | None = None) -> DataFrame:
        return read_archives(self.spark, self.archives, mode, csv)

    def split_scan(self, part_bytes: int = 1 << 18) -> DataFrame:
        """The archives unpacked and read in parts, smaller ones than by default so that parts end within the members."""
        sources = [{"path": path} for path in self.archives]
        return read_sources(self.spark, sources, run_folder(self.spark, "desempacado").removeprefix("file:"), True, part_bytes)

    def new_warehouse(self) -> Warehouse:
        return Warehouse(self.spark, run_folder(self.spark, "almacen"))

    def forced_entries(self) -> list[tuple[str, str]]:
        """The archives with one made-up publication date each, so that all of them load."""
        return [(str(date(2026, 1, 1) + timedelta(i)), path) for i, path in enumerate(self.archives)]


@dataclass(frozen=True)
class Check:
    name: str
    run: Callable[[Context], DataFrame]
    sql: str | None = None


CHECKS: dict[str, Check] = {}


def check(name: str, run: Callable[[Context], DataFrame], body: str | None = None, columns: str | None = None) -> None:
    sql = compose(body, columns, KEYWORDS) if body else None
    CHECKS[name] = Check(name, run, sql)


def rounded(frame: DataFrame) -> DataFrame:
    """Doubles to two decimals, without negative zero: their last digits depend on the order of summation."""

    def two_decimals(name: str) -> Column:
        value = F.round(F.col(name) + NUDGE, 2)
        return F.when(value == 0, F.lit(0.0)).otherwise(value).alias(name)

    return frame.select(
        *[two_decimals(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in frame.schema]
    )


# --- marts

for _name, _columns in MART_COLUMNS.items():
    check(_name, lambda c, n=_name: c.sources.mart(n), f"select * from {_name}", _columns)


# --- saved queries

_mart = MART_COLUMNS
check(
    "a1_resumen_general",
    lambda c: q.general_summary(c.sources.activity, c.sources.by_banner, c.sources.places),
    saved_sql("a1"),
    _mart["mart_resumen_general"].replace(" precio_promedio_general", ""),
)
check(
    "a2_resumen_productos",
    lambda c: q.product_summary(c.sources.comparables, c.sources.by_banner, c.sources.base.precios),
    saved_sql("a2"),
    _mart["mart_resumen_productos"],
)
check(
    "a3_precios_por_comercio",
    lambda c: q.price_by_chain(c.sources.activity, c.sources.by_banner, c.sources.names),
    saved_sql("a3"),
    _mart["mart_precios_por_comercio"],
)
check(
    "a4_precios_por_ubicacion",
    lambda c: q.price_by_place(c.sources.activity, c.sources.branches, c.sources.places),
    saved_sql("a4"),
    _mart["mart_precios_por_ubicacion"],
)
check(
    "a5_productos_con_promocion",
    lambda c: q.promoted_products(c.mart("promociones")),
    "select * from mart_promociones",
    _mart["mart_promociones"],
)
check(
    "a6_mayor_dispersion",
    lambda c: q.widest_spread(c.sources.comparables, c.sources.by_banner),
    saved_sql("a6"),
    _mart["mart_productos_mayor_dispersion"],
)
_FOUND = (
    "fecha_publicacion id_producto productos_descripcion productos_marca id_comercio id_bandera "
    "comercio_bandera_nombre id_sucursal sucursales_nombre sucursales_localidad sucursales_provincia "
    "productos_precio_lista productos_precio_unitario_promo1 productos_leyenda_promo1 "
    "productos_precio_unitario_promo2 productos_leyenda_promo2"
)
check(
    "a7_buscador_precios",
    lambda c: q.find_prices(c.sources.base, TEXT.upper()),
    joined(
        "f.*, c.comercio_bandera_nombre, s.sucursales_nombre, s.sucursales_localidad, s.sucursales_provincia",
        f"contains(lower(f.productos_descripcion), '{TEXT}')",
    ),
    _FOUND,
)
check(
    "a8_sucursales_georreferenciadas",
    lambda c: q.located_branches(c.mart("sucursales_geografia")),
    "select * from mart_sucursales_geografia",
    _mart["mart_sucursales_geografia"],
)

_PRICE_ROW = f"fecha_publicacion {P5} productos_precio_lista productos_precio_referencia"
check(
    "b1_precios_no_positivos",
    lambda c: q.non_positive_prices(c.sources.base.precios),
    f"select * from con_precio where p <= 0",
    _PRICE_ROW,
)
check(
    "b2_precios_muy_bajos",
    lambda c: q.very_low_prices(c.sources.base.precios),
    f"select * from con_precio where p > 0 and p < 10",
    _PRICE_ROW,
)
check(
    "b3_precios_mas_altos",
    lambda c: q.highest_prices(c.sources.base.precios),
    """select fecha_publicacion, id_producto, min(productos_descripcion) as productos_descripcion,
    min(productos_marca) as productos_marca, max(p) as precio_maximo, count(*) as cantidad_registros
    from con_precio group by all order by precio_maximo desc, fecha_publicacion, id_producto limit 100""",
    "fecha_publicacion id_producto productos_descripcion productos_marca precio_maximo cantidad_registros",
)
check(
    "b4_percentiles_altos",
    lambda c: q.high_percentiles(c.sources.base.precios, accuracy=1_000_000),
    """select fecha_publicacion, quantile_disc(p, 0.95) as precio_p95_aproximado,
    quantile_disc(p, 0.99) as precio_p99_aproximado, max(p) as precio_maximo from con_precio group by all""",
    "fecha_publicacion precio_p95_aproximado precio_p99_aproximado precio_maximo",
)
check(
    "b5_resumen_por_unidad",
    lambda c: q.summary_by_unit(c.sources.base.precios),
    """select productos_unidad_medida_presentacion, count(distinct id_producto) as cantidad_productos,
    avg(p) as precio_promedio, min(p) as precio_minimo, max(p) as precio_maximo from con_precio group by all""",
    "productos_unidad_medida_presentacion cantidad_productos precio_promedio precio_minimo precio_maximo",
)
check(
    "b6_productos_comparables",
    lambda c: q.comparable_summary(c.sources.base.precios),
    "select * from mart_evolucion_productos",
    _mart["mart_evolucion_productos"],
)
_FOUND_PRODUCT = """select f.fecha_publicacion, {p5}, count(*) as cantidad_registros, min(p) as precio_minimo,
    max(p) as precio_maximo, avg(p) as precio_promedio, avg(productos_precio_referencia) as precio_referencia_promedio
    from con_precio f left join dim_sucursales s on s.fecha_publicacion = f.fecha_publicacion
    and s.id_comercio = f.id_comercio and s.id_bandera = f.id_bandera and s.id_sucursal = f.id_sucursal
    where contains(lower(productos_descripcion), '{text}') {more} group by all
    order by {order} limit {limit}"""
_CHEAPEST = asc(f"precio_minimo precio_promedio fecha_publicacion {P5}")
check(
    "b7_buscador_avanzado",
    lambda c: q.find_products(c.sources.base, TEXT, limit=500),
    _FOUND_PRODUCT.format(p5=cols(P5), text=TEXT, more="", order=_CHEAPEST.replace("fecha_p", "f.fecha_p"), limit=500),
    _mart["mart_evolucion_productos"],
)
check(
    "b7_buscador_avanzado_filtros",
    lambda c: q.find_products(c.sources.base, "r", BRAND, None, PROVINCE, LOCALITY),
    _FOUND_PRODUCT.format(
        p5=cols(P5),
        text="r",
        more=f"and productos_marca = '{BRAND}' "
        f"and sucursales_provincia = '{PROVINCE}' and sucursales_localidad = '{LOCALITY}'",
        order=_CHEAPEST.replace("fecha_p", "f.fecha_p"),
        limit=100,
    ),
    _mart["mart_evolucion_productos"],
)
check(
    "b8_candidatos_canasta",
    lambda c: q.basket_candidates(c.sources.base.precios, KEYWORDS),
    "select * from mart_canasta_basica_candidatos",
    _mart["mart_canasta_basica_candidatos"],
)

_CONTAINS = f"contains(lower(productos_descripcion), '{TEXT}')"
_ENOUGH = f"least(cantidad_registros_actual, cantidad_registros_anterior) >= {MIN_ROWS}"
_CHANGE = (
    "precio_promedio_anterior precio_promedio_actual variacion_absoluta variacion_porcentual "
    "cantidad_registros_anterior cantidad_registros_actual"
)
check(
    "e1_evolucion_por_texto",
    lambda c: q.evolution_of(c.mart("evolucion_productos"), TEXT),
    f"""select * from mart_evolucion_productos where {_CONTAINS}
""",
    _mart["mart_evolucion_productos"],
)


def _changes_sql(rising: bool, where: str, limit: int) -> str:
    sign, way = (">", "desc") if rising else ("<", "asc")
    return f"""select * from mart_variacion_productos where {where} and {_ENOUGH}
        and variacion_porcentual is not null and variacion_absoluta {sign} 0
        order by variacion_porcentual {way}, cantidad_registros_actual desc, {asc(P5)} limit {limit}"""


for _key, _rising in (("e2_mayores_aumentos", True), ("e3_mayores_bajas", False)):
    check(
        _key,
        lambda c, r=_rising: q.largest_changes(c.mart("variacion_productos"), END, r, MIN_ROWS),
        _changes_sql(_rising, f"fecha_publicacion = date '{END}'", 50),
        f"fecha_publicacion fecha_anterior {PRODUCT} {_CHANGE}",
    )

_TWO_DATES = f"""select i.fecha_publicacion as fecha_inicial, n.fecha_publicacion as fecha_final,
    i.cantidad_registros_precios as registros_iniciales, n.cantidad_registros_precios as registros_finales,
    n.cantidad_registros_precios - i.cantidad_registros_precios as diferencia_registros,
    i.cantidad_productos_unicos as productos_iniciales, n.cantidad_productos_unicos as productos_finales,
    n.cantidad_productos_unicos - i.cantidad_productos_unicos as diferencia_productos,
    i.precio_promedio_general as precio_promedio_inicial, n.precio_promedio_general as precio_promedio_final,
    n.precio_promedio_general - i.precio_promedio_general as diferencia_precio_promedio,
    100 * (n.precio_promedio_general / nullif(i.precio_promedio_general, 0) - 1) as variacion_porcentual_precio_promedio
    from mart_resumen_general i, mart_resumen_general n
    where i.fecha_publicacion = date '{START}' and n.fecha_publicacion = date '{END}'"""
_TWO_DATES_COLUMNS = (
    "fecha_inicial fecha_final registros_iniciales registros_finales diferencia_registros productos_iniciales "
    "productos_finales diferencia_productos precio_promedio_inicial precio_promedio_final "
    "variacion_porcentual_precio_promedio"
)
check(
    "e4_comparacion_de_fechas",
    lambda c: q.compare_dates(c.mart("resumen_general"), START, END),
    _TWO_DATES,
    _TWO_DATES_COLUMNS,
)
check(
    "e5_datos_suficientes",
    lambda c: q.comparable_enough(c.mart("variacion_productos"), MIN_ROWS),
    f"""select * from mart_variacion_productos where {_ENOUGH}
""",
    f"fecha_publicacion fecha_anterior {PRODUCT} cantidad_registros_anterior cantidad_registros_actual "
    "precio_promedio_anterior precio_promedio_actual variacion_porcentual",
)
_PAIR = f"fecha_publicacion = date '{END}' and fecha_anterior = date '{START}'"
check(
    "e6_mayor_cambio_absoluto",
    lambda c: q.widest_changes(c.mart("variacion_productos"), START, END, MIN_ROWS),
    f"""select * from mart_variacion_productos where {_PAIR} and {_ENOUGH}
    order by abs(variacion_porcentual) desc nulls last, {asc(P5)} limit 100""",
    f"{PRODUCT} precio_promedio_anterior precio_promedio_actual variacion_absoluta variacion_porcentual",
)


# --- dashboard

_ON = f"fecha_publicacion = date '{END}'"


def _dashboard(name, mart, run, tail, columns, select="*"):
    check(name, lambda c: run(c.mart(mart)), f"select {select} from mart_{mart} {tail}", columns)


def _choice(name, mart, run, column, where=_ON):
    _dashboard(name, mart, run, f"where {where} and {column} <> ''", column, f"distinct {column}")


_UNITS, _BRANDS = "productos_unidad_medida_presentacion", "productos_marca"

_dashboard(
    "d01_titulares",
    "resumen_general",
    lambda m: d.headline(m, END),
    f"where {_ON}",
    "cantidad_registros_precios cantidad_productos_unicos cantidad_sucursales",
)
_dashboard(
    "d02_fechas_cargadas",
    "resumen_general",
    d.loaded_dates,
    "",
    "fechas_cargadas",
    "count(distinct fecha_publicacion) as fechas_cargadas",
)
_dashboard("d03_fechas", "resumen_general", d.publication_dates, "", "fecha_publicacion", "distinct fecha_publicacion")
_dashboard(
    "d04_ultima_fecha",
    "resumen_general",
    d.latest_date,
    "",
    "fecha_publicacion",
    "max(fecha_publicacion) as fecha_publicacion",
)
_dashboard(
    "d05_resumen_de_fecha",
    "resumen_general",
    lambda m: d.summary_of(m, END),
    f"where {_ON}",
    _mart["mart_resumen_general"],
)
_dashboard(
    "d06_comercios",
    "precios_por_comercio",
    lambda m: d.chains(m, END),
    f"where {_ON}",
    "comercio_bandera_nombre cantidad_registros cantidad_productos cantidad_sucursales precio_promedio "
    "precio_minimo precio_maximo",
)
_dashboard(
    "d07_busqueda_productos",
    "resumen_productos",
    lambda m: d.search_products(m, END, f" {TEXT[:1]} "),
    f"""where {_ON} and contains(lower(productos_descripcion), '{TEXT[:1]}')
    order by precio_minimo nulls last, id_producto limit 100""",
    "id_producto productos_descripcion productos_marca cantidad_registros precio_minimo precio_maximo "
    "precio_promedio precio_mediano_aproximado diferencia_absoluta_max_min diferencia_porcentual_max_min",
)
_dashboard(
    "d08_calidad",
    "calidad_precios",
    lambda m: d.quality_of(m, END),
    f"where {_ON}",
    _mart["mart_calidad_precios"],
)
_SUSPICIOUS = f"fecha_publicacion regla_calidad {P5} productos_precio_lista productos_precio_referencia"
_dashboard(
    "d09_sospechosos",
    "precios_sospechosos",
    lambda m: d.suspicious_rows(m, START),
    f"where fecha_publicacion = date '{START}'",
    _SUSPICIOUS,
)
_choice("d10_marcas", "productos_comparables", lambda m: d.brand_choices(m, END), _BRANDS)
_choice("d11_unidades", "productos_comparables", lambda m: d.unit_choices(m, END), _UNITS)
_ADVANCED = f"{PRODUCT} cantidad_registros precio_minimo precio_maximo precio_promedio precio_referencia_promedio"
_BEST = f"order by precio_minimo nulls last, cantidad_registros desc, {asc(P5)} limit 100"
_dashboard(
    "d12_buscador_avanzado",
    "productos_comparables",
    lambda m: d.advanced_search(m, END, TEXT, min_rows=MIN_ROWS),
    f"where {_ON} and cantidad_registros >= {MIN_ROWS} and {_CONTAINS} {_BEST}",
    f"{_ADVANCED} diferencia_porcentual_max_min",
)
_dashboard(
    "d12_buscador_avanzado_filtros",
    "productos_comparables",
    lambda m: d.advanced_search(m, END, "", BRAND, UNIT, 40000.0, 1),
    f"where {_ON} and {_BRANDS} = '{BRAND}' and {_UNITS} = '{UNIT}' and precio_minimo <= 40000 {_BEST}",
    f"{_ADVANCED} diferencia_porcentual_max_min",
)
_choice("d13_unidades_canasta", "canasta_basica_candidatos", lambda m: d.basket_unit_choices(m, END), _UNITS)


def _basket_sql(where: str, n: int) -> str:
    return f"""where {_ON} and {where} qualify row_number() over (partition by categoria_canasta
        order by cantidad_registros desc, {asc(f'precio_minimo {P5}')}) <= {n}"""


_BASKET = f"categoria_canasta {PRODUCT} precio_minimo precio_promedio cantidad_registros"
_dashboard(
    "d14_canasta_por_categoria",
    "canasta_basica_candidatos",
    lambda m: d.basket_top(m, END, KEYWORDS, MIN_ROWS),
    _basket_sql(f"cantidad_registros >= {MIN_ROWS}", 20),
    _BASKET,
)
_dashboard(
    "d14_canasta_filtros",
    "canasta_basica_candidatos",
    lambda m: d.basket_top(m, END, ["RING", "GEAR"], 1, 50000.0, UNIT, 5),
    _basket_sql(f"categoria_canasta in ('RING', 'GEAR') and precio_minimo <= 50000 and {_UNITS} = '{UNIT}'", 5),
    _BASKET,
)
check(
    "d15_metricas_de_dos_fechas",
    lambda c: d.date_metrics(c.mart("resumen_general"), START, END),
    _TWO_DATES,
    _TWO_DATES_COLUMNS + " diferencia_precio_promedio",
)
_choice(
    "d16_unidades_del_par", "variacion_productos", lambda m: d.pair_unit_choices(m, START, END), _UNITS, _PAIR
)
for _key, _rising in (("d17_subas_del_par", True), ("d18_bajas_del_par", False)):
    check(
        _key,
        lambda c, r=_rising: d.pair_changes(c.mart("variacion_productos"), START, END, r, MIN_ROWS),
        _changes_sql(_rising, _PAIR, 50),
        f"{PRODUCT} {_CHANGE}",
    )
    check(
        _key + "_unidad",
        lambda c, r=_rising: d.pair_changes(c.mart("variacion_productos"), START, END, r, MIN_ROWS, UNIT, 20),
        _changes_sql(_rising, f"{_PAIR} and {_UNITS} = '{UNIT}'", 20),
        f"{PRODUCT} {_CHANGE}",
    )
_choice("d19_marcas_del_texto", "evolucion_productos", lambda m: d.text_brand_choices(m, TEXT), _BRANDS, _CONTAINS)
_choice("d20_unidades_del_texto", "evolucion_productos", lambda m: d.text_unit_choices(m, TEXT), _UNITS, _CONTAINS)


def _candidates_sql(more: str) -> str:
    return f"""where {_CONTAINS} {more} group by {cols(P5)}
        order by fechas_disponibles desc, registros_totales desc, {asc(P5)} limit 100"""


_CANDIDATE = f"""{cols(P5)}, count(distinct fecha_publicacion) as fechas_disponibles,
    cast(sum(cantidad_registros) as bigint) as registros_totales"""
_dashboard(
    "d21_candidatos",
    "evolucion_productos",
    lambda m: d.product_candidates(m, TEXT),
    _candidates_sql(""),
    f"{P5} fechas_disponibles registros_totales",
    _CANDIDATE,
)
_dashboard(
    "d21_candidatos_filtros",
    "evolucion_productos",
    lambda m: d.product_candidates(m, TEXT, BRAND, UNIT),
    _candidates_sql(f"and {_BRANDS} = '{BRAND}' and {_UNITS} = '{UNIT}'"),
    f"{P5} fechas_disponibles registros_totales",
    _CANDIDATE,
)

def _series(m: DataFrame) -> DataFrame:
    """The best-covered product of a search is looked up first, as a person would choose it."""
    first = d.product_candidates(m, TEXT, limit=1).select(*P5.split()).first()
    return d.product_series(m, *first)


_FIRST = f"(select {cols(P5)} from mart_evolucion_productos {_candidates_sql('').replace('limit 100', 'limit 1')}) k"
_FIRST = _FIRST.replace("fechas_disponibles", "count(distinct fecha_publicacion)").replace(
    "registros_totales", "sum(cantidad_registros)"
)
_SERIES_SQL = f"""(select m.* from mart_evolucion_productos m, {_FIRST} where m.id_producto = k.id_producto and
    {' and '.join(f'm.{c} is not distinct from k.{c}' for c in PRODUCT.split())}) serie"""
_SERIES_COLUMNS = (
    "fecha_publicacion cantidad_registros precio_minimo precio_maximo precio_promedio precio_referencia_promedio"
)
check(
    "d22_serie_de_producto",
    lambda c: _series(c.mart("evolucion_productos")),
    f"select * from {_SERIES_SQL}",
    _SERIES_COLUMNS,
)
check(
    "d23_cambio_de_serie",
    lambda c: d.series_change(_series(c.mart("evolucion_productos"))),
    f"""select primera_fecha, ultima_fecha, promedio_inicial, promedio_final,
    promedio_final - promedio_inicial as variacion_absoluta,
    100 * (promedio_final - promedio_inicial) / nullif(promedio_inicial, 0) as variacion_porcentual
    from (select min(fecha_publicacion) as primera_fecha, max(fecha_publicacion) as ultima_fecha,
          arg_min(precio_promedio, fecha_publicacion) as promedio_inicial,
          arg_max(precio_promedio, fecha_publicacion) as promedio_final from {_SERIES_SQL}) extremos""",
    "primera_fecha ultima_fecha promedio_inicial promedio_final variacion_absoluta variacion_porcentual",
)
check(
    "d24_serie_por_metrica",
    lambda c: d.series_by_metric(_series(c.mart("evolucion_productos"))),
    " union all ".join(
        f"select fecha_publicacion, '{m}' as metrica, {m} as precio from {_SERIES_SQL}"
        for m in ("precio_promedio", "precio_minimo", "precio_maximo")
    ),
    "fecha_publicacion metrica precio",
)
_choice("d25_provincias", "precios_por_ubicacion", lambda m: d.province_choices(m, END), "sucursales_provincia")
_choice(
    "d26_localidades",
    "precios_por_ubicacion",
    lambda m: d.locality_choices(m, END, PROVINCE),
    "sucursales_localidad",
    f"{_ON} and sucursales_provincia = '{PROVINCE}'",
)
_PLACE = _mart["mart_precios_por_ubicacion"].replace("fecha_publicacion ", "")
_BUSIEST = "order by cantidad_productos desc, sucursales_localidad nulls last, sucursales_provincia nulls last"
_dashboard(
    "d27_ubicaciones",
    "precios_por_ubicacion",
    lambda m: d.places(m, END),
    f"where {_ON}",
    _PLACE,
)
_dashboard(
    "d27_ubicaciones_filtros",
    "precios_por_ubicacion",
    lambda m: d.places(m, END, PROVINCE, LOCALITY),
    f"where {_ON} and sucursales_provincia = '{PROVINCE}' and sucursales_localidad = '{LOCALITY}'",
    _PLACE,
)
_dashboard(
    "d28_localidades_principales",
    "precios_por_ubicacion",
    lambda m: d.busiest_places(d.places(m, END)),
    f"where {_ON} {_BUSIEST} limit 30",
    _PLACE,
)
_dashboard(
    "d29_promociones",
    "promociones",
    lambda m: d.promotions_of(m, END),
    f"""where {_ON} order by cantidad_registros_con_promo1 + cantidad_registros_con_promo2 desc,
    productos_descripcion nulls last, id_producto limit 300""",
    "productos_descripcion productos_marca cantidad_registros_con_promo1 cantidad_registros_con_promo2 "
    "precio_promedio_lista precio_promedio_promo1 precio_promedio_promo2",
)
_dashboard(
    "d30_dispersion",
    "productos_mayor_dispersion",
    lambda m: d.spread_of(m, END),
    f"where {_ON} order by diferencia_absoluta_max_min desc, cantidad_registros desc, id_producto limit 100",
    "productos_descripcion productos_marca cantidad_registros precio_minimo precio_maximo precio_promedio "
    "diferencia_absoluta_max_min diferencia_porcentual_max_min",
)
_BRANCH = (
    "comercio_bandera_nombre sucursales_nombre sucursales_localidad sucursales_provincia sucursales_latitud "
    "sucursales_longitud"
)
_BRANCH_ORDER = asc(
    "sucursales_provincia sucursales_localidad comercio_bandera_nombre sucursales_nombre sucursales_latitud "
    "sucursales_longitud"
)
_dashboard(
    "d31_sucursales",
    "sucursales_geografia",
    lambda m: d.branches_of(m, END),
    f"where {_ON}",
    _BRANCH,
)
_dashboard(
    "d32_puntos_de_mapa",
    "sucursales_geografia",
    lambda m: d.map_points(d.branches_of(m, END)),
    f"where {_ON}",
    "lat lon",
    "sucursales_latitud as lat, sucursales_longitud as lon",
)


# --- cleaning: line items published as text rows


def _text_rows(c: Context) -> DataFrame:
    """Text rows in the shape of the raw scan; rows with line number 7 lack their last field."""
    named = {
        "id_comercio": F.col("id"),
        "id_bandera": F.col("l_orderkey").cast("string"),
        "id_sucursal": F.col("l_linenumber").cast("string"),
        "productos_marca": F.col("texto"),
        "productos_precio_lista": F.col("numero"),
        "productos_leyenda_promo1": F.col("momento"),
    }
    blank = F.col("id") == ""
    fields = [F.when(blank, F.lit(" ")).otherwise(named.get(h, F.lit(""))) for h in TABLES[FACT].header]
    whole = F.array(*fields)
    return c.texts.select(
        F.concat(F.lit("2001-02-30/"), "estado_linea", F.lit("/1999-12-31.zip")).alias("archivo_origen"),
        F.lit("productos.csv").alias("csv"),
        F.lit("fila").alias("tipo"),
        # Generated, not projected: like the fields of a scan they are made once and then referred to.
        F.explode(
            F.array(F.when(F.col("l_linenumber") == 7, F.slice(whole, 1, len(fields) - 1)).otherwise(whole))
        ).alias("campos"),
        "*",
    )


_KEY = "l_orderkey l_linenumber l_suppkey"


def _keyed(column, name):
    return lambda c: _text_rows(c).select(*_KEY.split(), column().alias(name))


check(
    "c1_filas_con_contenido",
    lambda c: _text_rows(c).where(cleaning.has_content(F.col("campos"))).select(*_KEY.split()),
    "select * from textos where id <> ''",
    _KEY,
)
check(
    "c2_cantidad_de_campos",
    lambda c: _text_rows(c).where(cleaning.has_size(F.col("campos"), 17)).select(*_KEY.split()),
    "select * from textos where l_linenumber <> 7",
    _KEY,
)
check(
    "c3_pie_de_archivo",
    lambda c: _text_rows(c).where(cleaning.is_footer(F.col("campos"))).select(*_KEY.split()),
    "select * from textos where lower(strip_accents(id)) like 'ultima actualizacion%'",
    _KEY,
)
check(
    "c4_primera_columna_numerica",
    lambda c: _text_rows(c).where(cleaning.is_identifier(F.col("id"))).select(*_KEY.split()),
    r"select * from textos where regexp_full_match(id, '\s*[0-9]+\s*')",
    _KEY,
)
check(
    "c5_texto_o_nulo",
    _keyed(lambda: cleaning.text_or_null(F.col("texto")), "valor"),
    """select *, case when trim(texto, chr(9) || chr(10) || ' ') not in ('', 'nan', 'None')
    then trim(texto, chr(9) || chr(10) || ' ') end as valor from textos""",
    f"{_KEY} valor",
)
check(
    "c6_numero_o_nulo",
    _keyed(lambda: cleaning.number_or_null(F.col("numero")), "precio"),
    """select *, case when numero like '%,%' then try_cast(replace(replace(numero, '.', ''), ',', '.') as double)
    when numero not like '%d' and numero <> 'nan' then try_cast(trim(numero, chr(9) || ' ') as double) end as precio
    from textos""",
    f"{_KEY} precio",
)
check(
    "c7_momento_o_nulo",
    lambda c: _text_rows(c).select(
        *_KEY.split(), cleaning.timestamp_or_null(F.col("momento")).cast("string").alias("instante")
    ),
    """select *, case when momento <> 'sin fecha'
    then strftime(strptime(left(momento, 10), '%Y-%m-%d') + interval 7 hour, '%Y-%m-%d %H:%M:%S') end as instante
    from textos""",
    f"{_KEY} instante",
)
# The first date in the name is not a real one: the member has no date, although a later one would be valid.
check(
    "c8_columnas_tecnicas",
    lambda c: _text_rows(c).select(
        *_KEY.split(), "archivo_origen", cleaning.publication_date(F.col("archivo_origen")).alias(DATE)
    ),
    """select *, '2001-02-30/' || estado_linea || '/1999-12-31.zip' as archivo_origen,
    cast(null as date) as fecha_publicacion from textos""",
    f"{_KEY} archivo_origen fecha_publicacion",
)
check(
    "c9_limpieza_completa",
    lambda c: cleaning.clean(_text_rows(c), TABLES[FACT], "2026-05-23").select(
        *[F.col(name) for name in TABLES[FACT].output]
    ),
    f"""select date '2026-05-23' as fecha_publicacion, trim(id, chr(9) || ' ') as id_comercio,
    cast(l_orderkey as varchar) as id_bandera, cast(l_linenumber as varchar) as id_sucursal,
    case when l_linenumber in (1, 2) then try_cast(replace(replace(numero, '.', ''), ',', '.') as double)
         when l_linenumber in (3, 6) then try_cast(trim(numero, chr(9) || ' ') as double) end as productos_precio_lista,
    case when texto <> 'None' then trim(texto, chr(10) || ' ') end as productos_marca,
    momento as productos_leyenda_promo1, '2001-02-30/' || estado_linea || '/1999-12-31.zip' as archivo_origen,
    {', '.join(
        f"cast(null as {'double' if n in TABLES[FACT].numeric else 'varchar'}) as {n}"
        for n in TABLES[FACT].output
        if n not in ('fecha_publicacion', 'id_comercio', 'id_bandera', 'id_sucursal', 'productos_precio_lista',
                     'productos_marca', 'productos_leyenda_promo1', 'archivo_origen'))}
    from textos where l_linenumber <> 7 and regexp_full_match(id, '\\s*[0-9]+\\s*')""",
    " ".join(TABLES[FACT].output),
)


# --- resource metadata: one published resource per order

_RESOURCE = "id name format url created metadata_modified last_modified"
_NORMAL = """(select posicion, id, coalesce(nullif(name, ''), description, '') as name, coalesce(format, '') as format,
    url, created, metadata_modified, last_modified from recursos) n"""
_STAMP = "coalesce(nullif(last_modified, ''), nullif(metadata_modified, ''), nullif(created, ''))"
_INSTANT = f"""case when {_STAMP} = 'ayer' then null
    when {_STAMP} like '%-03:00' then strptime(left({_STAMP}, 19), '%Y-%m-%dT%H:%M:%S') + interval 3 hour
    else strptime(left({_STAMP}, 19), '%Y-%m-%dT%H:%M:%S') end"""


def _text_date(column: str) -> str:
    # An underscore is part of a word, so a date right after it is not free-standing.
    return f"try_cast(nullif(regexp_extract({column}, '(^|[^A-Za-z0-9_])(20[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}})', 2), '') as date)"


_DATED = f"""(select *, {_INSTANT} as momento, {_text_date('name')} as fecha_nombre,
    coalesce({_text_date('name')}, {_text_date('url')}, cast({_INSTANT} as date)) as fecha
    from {_NORMAL} where (lower(format) = 'zip' or lower(url) like '%.zip') and url <> '') d"""
_NEWEST = "order by momento desc nulls last, fecha_nombre desc nulls last, posicion"
_DAY = "2000-02-10"


def _normal(c: Context) -> DataFrame:
    return k.normalized(c.resources)


check("k1_recursos_normalizados", _normal, f"select * from {_NORMAL}", f"posicion {_RESOURCE}")
check(
    "k2_recursos_zip",
    lambda c: _normal(c).where(k.is_zip() & (F.col("url") != "")).select(*_RESOURCE.split()),
    f"select * from {_NORMAL} where (lower(format) = 'zip' or lower(url) like '%.zip') and url <> ''",
    _RESOURCE,
)
check(
    "k3_fecha_de_recurso",
    lambda c: k.dated(_normal(c)).select("id", "fecha", "fecha_nombre"),
    f"select * from {_DATED}",
    "id fecha fecha_nombre",
)
check("k4_ultimo_recurso", lambda c: k.latest(_normal(c)), f"select * from {_DATED} {_NEWEST} limit 1", _RESOURCE)
check(
    "k5_recurso_de_fecha",
    # Asking for a date without a resource is an error, so the date is one of those on offer.
    lambda c: k.for_date(_normal(c), k.available_dates(_normal(c)).agg(F.max("fecha")).first()[0]),
    f"select * from {_DATED} where fecha = (select max(fecha) from {_DATED}) {_NEWEST} limit 1",
    _RESOURCE,
)


def _per_date(where: str) -> str:
    return f"select * from {_DATED} where {where} qualify row_number() over (partition by fecha {_NEWEST}) = 1"


check(
    "k6_recursos_entre_fechas",
    lambda c: k.between_dates(_normal(c), "1998-01-01", "1999-12-31"),
    _per_date("fecha >= date '1998-01-01' and fecha <= date '1999-12-31'"),
    f"fecha {_RESOURCE}",
)
check(
    "k7_recursos_recientes",
    lambda c: k.recent(_normal(c), 30),
    _per_date(f"fecha > (select max(fecha) from {_DATED}) - 30"),
    f"fecha {_RESOURCE}",
)
check(
    "k7_recursos_recientes_hasta",
    lambda c: k.recent(_normal(c), 365, _DAY),
    _per_date(f"fecha > date '{_DAY}' - 365 and fecha <= date '{_DAY}'"),
    f"fecha {_RESOURCE}",
)
check(
    "k8_fechas_disponibles",
    lambda c: k.available_dates(_normal(c)),
    f"select distinct fecha from {_DATED} where fecha is not null",
    "fecha",
)


# --- archives written from the price view, read back, inspected and loaded


def _texts_of(frame: DataFrame) -> DataFrame:
    return cleaning.clean(frame, TABLES[FACT])


_SUMS = "registros con_precio productos suma_precio"
_TOTALS_SQL = """count(*) as registros, count(productos_precio_lista) as con_precio,
    count(distinct id_producto) as productos, cast(sum(cast(productos_precio_lista as decimal(18,2))) as varchar)
    as suma_precio"""


def _totals(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.groupBy(*keys).agg(
        F.count("*").alias("registros"),
        F.count("productos_precio_lista").alias("con_precio"),
        F.count_distinct("id_producto").alias("productos"),
        F.sum(F.col("productos_precio_lista").cast("decimal(18,2)")).cast("string").alias("suma_precio"),
    )


check(
    "s1_s2_s3_lectura_de_archivos",
    lambda c: _totals(_texts_of(c.scan(LOAD, "productos.csv")), DATE, "id_comercio", "id_bandera"),
    f"select fecha_publicacion, id_comercio, id_bandera, {_TOTALS_SQL} from fact_precios group by all",
    f"fecha_publicacion id_comercio id_bandera {_SUMS}",
)
check(
    "s1_s2_lectura_por_partes",
    lambda c: _totals(_texts_of(whole_members(c.split_scan())), DATE, "id_comercio", "id_bandera"),
    f"select fecha_publicacion, id_comercio, id_bandera, {_TOTALS_SQL} from fact_precios group by all",
    f"fecha_publicacion id_comercio id_bandera {_SUMS}",
)
check(
    "s4_fecha_forzada",
    lambda c: _totals(cleaning.clean(c.scan(LOAD, "productos.csv"), TABLES[FACT], "2026-05-23"), DATE),
    f"select date '2026-05-23' as fecha_publicacion, {_TOTALS_SQL} from fact_precios group by all",
    f"fecha_publicacion {_SUMS}",
)


def _exported(c: Context, how: str) -> DataFrame:
    warehouse = c.new_warehouse()
    table = "mart_productos_comparables"
    warehouse.replace(table, c.mart("productos_comparables"), by_date=True)
    folder = run_folder(c.spark, "exportado")
    export(warehouse, table, folder)
    if how == "csv":
        schema = c.mart("productos_comparables").schema
        return c.spark.read.schema(schema).option("header", True).csv(f"{folder}/{table}.csv")
    return c.spark.read.parquet(f"{folder}/{table}.parquet")


for _how in ("csv", "parquet"):
    check(
        {"csv": "s5_exportacion_csv", "parquet": "s6_exportacion_parquet"}[_how],
        lambda c, h=_how: _exported(c, h),
        "select * from mart_productos_comparables",
        _mart["mart_productos_comparables"],
    )


def _base_warehouse(c: Context) -> Warehouse:
    """A warehouse whose base tables are the views, appended column by column name."""
    warehouse = c.new_warehouse()
    warehouse.create_base()
    base = c.sources.base
    for table, frame in ((CHAINS, base.comercios), (BRANCHES, base.sucursales), (FACT, base.precios)):
        missing = {f.name: F.lit(None).cast(f.dataType) for f in TABLES[table].schema if f.name not in frame.columns}
        warehouse.append(table, frame.withColumns(missing))
    return warehouse


def _full_build(c: Context) -> DataFrame:
    warehouse = _base_warehouse(c)
    rows = build_marts(warehouse, keywords=KEYWORDS)
    written = [
        warehouse.read(name).groupBy().agg(F.lit(name).alias("mart"), F.count("*").alias("filas")) for name in rows
    ]
    result = written[0]
    for frame in written[1:]:
        result = result.unionByName(frame)
    return result


check(
    "s7_s8_s11_construccion_de_marts",
    _full_build,
    " union all ".join(f"select '{m}' as mart, count(*) as filas from {m}" for m in MARTS),
    "mart filas",
)


def _one_mart(c: Context) -> DataFrame:
    """Only the variation mart: its dependency is rebuilt first, both are read back from disk."""
    warehouse = _base_warehouse(c)
    build_marts(warehouse, only="mart_variacion_productos")
    return warehouse.read("mart_variacion_productos")


check(
    "s11_un_mart_con_dependencias",
    _one_mart,
    "select * from mart_variacion_productos",
    _mart["mart_variacion_productos"],
)


def _missing_tables(c: Context) -> DataFrame:
    warehouse = c.new_warehouse()
    warehouse.replace("mart_calidad_precios", c.mart("calidad_precios"))
    present = [t for t in (*TABLES, "mart_calidad_precios") if not warehouse.missing([t])]
    return warehouse.read("mart_calidad_precios").select(DATE, F.lit(", ".join(present)).alias("presentes"))


check(
    "s9_tablas_requeridas",
    _missing_tables,
    "select fecha_publicacion, 'mart_calidad_precios' as presentes from mart_calidad_precios",
    "fecha_publicacion presentes",
)


def _file_reports(c: Context) -> DataFrame:
    return inspection.file_reports(c.scan(INSPECT))


_PUBLISHED = """(select fecha_publicacion, 'productos.csv' as csv, count(*) as filas from fact_precios group by all) p"""
check(
    "q1_reportes_por_archivo",
    lambda c: _file_reports(c)
    .where(F.col("csv") == "productos.csv")
    .groupBy(cleaning.publication_date(F.col("archivo_origen")).alias(DATE), "csv")
    .agg(
        F.min("present").alias("present"),
        F.max("empty").alias("empty"),
        F.min("header_ok").alias("header_ok"),
        F.sum("rows_total").alias("rows_total"),
        F.sum("rows_valid").alias("rows_valid"),
        F.sum("rows_invalid").alias("rows_invalid"),
        F.sum("footer_rows_removed").alias("footer_rows_removed"),
        F.count("error").alias("errores"),
    ),
    f"""select fecha_publicacion, csv, true as present, false as empty, true as header_ok, filas as rows_total,
    filas as rows_valid, cast(0 as bigint) as rows_invalid, cast(0 as bigint) as footer_rows_removed,
    cast(0 as bigint) as errores from {_PUBLISHED}""",
    "fecha_publicacion csv present empty header_ok rows_total rows_valid rows_invalid footer_rows_removed errores",
)
# How many members there are depends on the partitions; that none is broken does not.
check(
    "q2_miembros_por_archivo",
    lambda c: inspection.member_counts(c.scan(HEADERS))
    .groupBy()
    .agg(
        F.sum(F.col("inner_zips_total") - F.col("inner_zips_valid")).alias("ilegibles"),
        F.sum("inner_zips_empty").alias("vacios"),
        F.sum("inner_zips_corrupt").alias("corruptos"),
    ),
    "select cast(0 as bigint) as ilegibles, cast(0 as bigint) as vacios, cast(0 as bigint) as corruptos from region limit 1",
    "ilegibles vacios corruptos",
)
_FILE_TOTALS = """select 'productos.csv' as csv, count(*) as rows, cast(0 as bigint) as invalid_rows,
    cast(0 as bigint) as footer_rows_removed from fact_precios"""


def _price_file(totals: DataFrame) -> DataFrame:
    return totals.where(F.col("csv") == "productos.csv").select("csv", "rows", "invalid_rows", "footer_rows_removed")


check(
    "q3_totales_por_archivo",
    lambda c: _price_file(inspection.totals_by_file(_file_reports(c))),
    _FILE_TOTALS,
    "csv rows invalid_rows footer_rows_removed",
)
check(
    "q4_errores_de_inspeccion",
    lambda c: inspection.problems(_file_reports(c), c.scan(HEADERS)).groupBy().agg(F.count("*").alias("errores")),
    "select cast(count(*) - count(*) as bigint) as errores from fact_precios",
    "errores",
)
# Archives with all rows, in a member for each date and banner that is damaged by the banner's number: empty, no archive, another header,
# no branches, cut in the middle of the prices, short rows and footers.
_MEMBERS = """(select fecha_publicacion, id_bandera, cast(id_bandera as int) % 6 as clase, count(*) as filas,
    count(distinct id_sucursal) as sucursales from fact_precios where fecha_publicacion is not null group by all) miembros"""
_BROKEN = f"""(select fecha_publicacion, csv, count_if(presente) as presentes, count_if(presente and not (csv = 'productos.csv' and clase = 2)) as con_encabezado,
    cast(coalesce(sum(case when presente then validas end), 0) as bigint) as validas,
    cast(coalesce(sum(case when csv = 'productos.csv' and clase = 5 then 2 end), 0) as bigint) as invalidas,
    count_if(csv <> 'sucursales.csv' and clase = 5) as pies
    from (select fecha_publicacion, clase, csv, not (csv = 'sucursales.csv' and clase = 3) as presente,
        case csv when 'comercio.csv' then 1 when 'sucursales.csv' then sucursales when 'productos.csv' then case when clase = 4 then filas // 2 else filas end end as validas
        from {_MEMBERS}, (values ('comercio.csv'), ('sucursales.csv'), ('productos.csv')) archivos(csv) where clase >= 2) partes
    group by all) rotos"""
check(
    "q1_reportes_de_archivos_rotos",
    lambda c: inspection.file_reports(c.scan_broken(INSPECT))
    .groupBy(cleaning.publication_date(F.col("archivo_origen")).alias(DATE), "csv")
    .agg(
        F.count_if("present").alias("presentes"),
        F.count_if("header_ok").alias("con_encabezado"),
        F.sum("rows_total").alias("filas"),
        F.sum("rows_valid").alias("validas"),
        F.sum("rows_invalid").alias("invalidas"),
        F.sum("footer_rows_removed").alias("pies"),
    ),
    f"select fecha_publicacion, csv, presentes, con_encabezado, validas + invalidas as filas, validas, invalidas, pies from {_BROKEN}",
    "fecha_publicacion csv presentes con_encabezado filas validas invalidas pies",
)
check(
    "q2_miembros_de_archivos_rotos",
    lambda c: inspection.member_counts(c.scan_broken(HEADERS)).drop("zip"),
    f"""select count(*) as inner_zips_total, count_if(clase >= 2) as inner_zips_valid, count_if(clase = 0) as inner_zips_empty,
    count_if(clase = 1) as inner_zips_corrupt from {_MEMBERS} group by fecha_publicacion""",
    "inner_zips_total inner_zips_valid inner_zips_empty inner_zips_corrupt",
)
check(
    "q3_s10_totales_de_archivos_rotos",
    lambda c: inspect_archives(c.spark, c.broken, run_folder(c.spark, "inspeccion"))["totales"],
    f"""select csv, sum(presentes) as files_present, sum(con_encabezado) as files_with_valid_header, sum(validas) as rows,
    sum(invalidas) as invalid_rows, sum(pies) as footer_rows_removed from {_BROKEN} group by csv""",
    "csv files_present files_with_valid_header rows invalid_rows footer_rows_removed",
)
check(
    "q4_errores_de_archivos_rotos",
    lambda c: inspection.problems(
        inspection.file_reports(c.scan_broken(INSPECT)), c.scan_broken(HEADERS).where("tipo = 'miembro'")
    ).select("archivo_origen", "archivo_csv", "error"),
    f"""select fecha_publicacion || '/bandera_' || id_bandera || '.zip' as archivo_origen, case clase when 4 then 'productos.csv' end as archivo_csv,
    case clase when 0 then '{inspection.EMPTY_MEMBER}' when 1 then '{inspection.CORRUPT_MEMBER}' else '{inspection.NOT_UTF8}' end as error
    from {_MEMBERS} where clase in (0, 1, 4)""",
    "archivo_origen archivo_csv error",
)


def _load_with_warnings(c: Context) -> DataFrame:
    warehouse = c.new_warehouse()
    ingest.load_archives(warehouse, [(None, path) for path in c.broken])
    control = ingest.control_table(warehouse)
    columns = ["estado", "errores", *[f"filas_{t}" for t in TABLES]]
    return control.select(*columns, F.from_json("fechas_publicacion", "array<string>")[0].cast("date").alias(DATE))


check(
    "i9_i10_carga_con_avisos",
    _load_with_warnings,
    # Members without a file load the others; those that are cut or have another header load nothing.
    f"""select case when count_if(clase < 5) > 0 then 'success_with_warnings' else 'success' end as estado, count_if(clase < 5) as errores,
    count_if(clase in (3, 5)) as filas_{CHAINS}, cast(coalesce(sum(case when clase = 5 then sucursales end), 0) as bigint) as filas_{BRANCHES},
    cast(coalesce(sum(case when clase in (3, 5) then filas end), 0) as bigint) as filas_{FACT}, fecha_publicacion
    from {_MEMBERS} group by fecha_publicacion""",
    f"estado errores filas_{CHAINS} filas_{BRANCHES} filas_{FACT} fecha_publicacion",
)
check(
    "s10_resumen_de_inspeccion",
    lambda c: _price_file(inspect_archives(c.spark, c.archives, run_folder(c.spark, "inspeccion"))["totales"]),
    _FILE_TOTALS,
    "csv rows invalid_rows footer_rows_removed",
)

check(
    "i2_fechas_ofrecidas",
    lambda c: ingest.offered_dates(c.scan(MEMBERS)).select("fecha").distinct(),
    "select distinct fecha_publicacion as fecha from fact_precios",
    "fecha",
)


def _loaded(c: Context) -> Warehouse:
    warehouse = c.new_warehouse()
    ingest.load_archives(warehouse, c.forced_entries())
    return warehouse


def _control(warehouse: Warehouse) -> DataFrame:
    """Loads per state with their rows and errors."""
    return (
        ingest.control_table(warehouse)
        .groupBy("estado", "modo_carga")
        .agg(F.sum("filas_fact_precios").alias("filas"), F.sum("errores").alias("errores"))
    )


def _first_load(c: Context) -> DataFrame:
    return _totals(_loaded(c).read(FACT), "id_comercio", "id_bandera")


def _loaded_dates(c: Context) -> DataFrame:
    warehouse = _base_warehouse(c)
    return c.spark.createDataFrame([(day,) for day in warehouse.dates(FACT)], f"{DATE} date")


def _second_load(c: Context) -> DataFrame:
    """The same archives twice: the second time every date is there already."""
    warehouse = _loaded(c)
    ingest.load_archives(warehouse, c.forced_entries())
    return _control(warehouse)


def _reload(c: Context) -> DataFrame:
    """The same archives again, emptying their dates first: totals stay as they are."""
    warehouse = _loaded(c)
    ingest.load_archives(warehouse, c.forced_entries(), reload_existing=True)
    return _totals(warehouse.read(FACT), "id_comercio", "id_bandera")


def _replace(c: Context) -> DataFrame:
    """A replacing load over a loaded warehouse starts tables and control anew."""
    warehouse = _loaded(c)
    ingest.load_archives(warehouse, c.forced_entries(), mode=ingest.REPLACE)
    return _control(warehouse).groupBy("estado").agg(F.sum("filas").alias("filas"), F.sum("errores").alias("errores"))


_BY_BANNER = f"select id_comercio, id_bandera, {_TOTALS_SQL} from fact_precios group by all"
_STATES = "estado modo_carga filas errores"


def _states(*rows: tuple[str, str]) -> str:
    return " union all ".join(
        f"select '{state}' as estado, 'append' as modo_carga, {n} as filas, cast(0 as bigint) as errores from fact_precios"
        for state, n in rows
    )


check(
    "i1_fechas_cargadas",
    _loaded_dates,
    "select distinct fecha_publicacion from fact_precios",
    "fecha_publicacion",
)
check("i6_i10_carga_de_archivos", _first_load, _BY_BANNER, f"id_comercio id_bandera {_SUMS}")
check(
    "i3_i7_i8_i9_carga_repetida",
    _second_load,
    _states(("success", "count(*)"), ("skipped", "count(*) - count(*)")),
    _STATES,
)
check("i4_recarga_de_fechas", _reload, _BY_BANNER, f"id_comercio id_bandera {_SUMS}")
check(
    "i5_reemplazo",
    _replace,
    "select 'success' as estado, count(*) as filas, cast(0 as bigint) as errores from fact_precios",
    "estado filas errores",
)


# --- result shaping

_LABELLED = {
    "fecha_publicacion": "Fecha",
    "id_producto": "ID producto",
    "productos_descripcion": "Producto",
    "productos_marca": "Marca",
    "productos_cantidad_presentacion": "Presentación",
    "productos_unidad_medida_presentacion": "Unidad",
    "precio_promedio_actual": "Precio promedio actual",
    "variacion_porcentual": "Variación %",
    "cantidad_registros_actual": "Registros actuales",
}


def _display(c: Context) -> DataFrame:
    shown = c.mart("variacion_productos").select(*_LABELLED)
    doubles = ("precio_promedio_actual", "variacion_porcentual")
    return display.for_display(shown.withColumns({n: F.col(n) + NUDGE for n in doubles}))


CHECKS["f1_columnas_de_pantalla"] = Check(
    "f1_columnas_de_pantalla",
    _display,
    f"""select {', '.join(f'{n} as "{label}"' for n, label in _LABELLED.items())} from (
    {compose('select * from mart_variacion_productos', ' '.join(_LABELLED), KEYWORDS)}) mostrado""",
)


def _formatted(column, name):
    return lambda c: c.views.table("orders").select(
        "o_orderkey", column(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))).alias(name)
    )


def _format_sql(pattern: str, swap: str) -> str:
    return f"""select o_orderkey, case when o_orderstatus <> 'P' then translate({pattern}, {swap}) else '-' end as texto
    from orders"""


check(
    "f2_formato_entero",
    _formatted(display.integer_text, "texto"),
    _format_sql("format('{:,}', cast(trunc(o_totalprice) as bigint))", "',', '.'"),
    "o_orderkey texto",
)
check(
    "f3_formato_moneda",
    _formatted(display.currency_text, "texto"),
    _format_sql("format('${:,.2f}', o_totalprice)", "',.', '.,'"),
    "o_orderkey texto",
)
check(
    "f4_formato_porcentaje",
    _formatted(display.percentage_text, "texto"),
    _format_sql("format('{:,.2f}%', o_totalprice)", "',.', '.,'"),
    "o_orderkey texto",
)
check(
    "f5_f7_barras_ordenadas",
    lambda c: display.ranked_bars(
        display.chart_rows(
            d.pair_changes(c.mart("variacion_productos"), START, END, True, MIN_ROWS),
            [F.desc("variacion_porcentual"), F.desc("cantidad_registros_actual"), F.asc("productos_descripcion")],
        ),
        "variacion_porcentual",
    ).select("producto", "variacion_porcentual"),
    f"""select left(coalesce(productos_descripcion, ''), 58) || ' | ' || coalesce(productos_marca, 'S/M') as producto,
    variacion_porcentual from ({_changes_sql(True, _PAIR, 20)}) subas""",
    "producto variacion_porcentual",
)
check(
    "f6_opciones_de_producto",
    lambda c: display.candidate_option(d.product_candidates(c.mart("evolucion_productos"), TEXT)).select(
        "id_producto", "opcion"
    ),
    f"""select id_producto, coalesce(productos_descripcion, '') || ' | ' || coalesce(productos_marca, 'S/M') || ' | '
    || cast(productos_cantidad_presentacion as varchar) || ' ' || coalesce(productos_unidad_medida_presentacion, '')
    || ' | fechas: ' || cast(fechas_disponibles as varchar) as opcion
    from (select {_CANDIDATE} from mart_evolucion_productos {_candidates_sql('')}) candidatos""",
    "id_producto opcion",
)
