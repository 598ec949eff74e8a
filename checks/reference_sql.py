"""SQL of every mart and query over the views, for the checking database.

Marts are common table expressions computed straight from joined base rows, deliberately without the
shared aggregates and weights the Spark side uses.
"""

from __future__ import annotations

from checks import views

PRODUCT = "productos_descripcion productos_marca productos_cantidad_presentacion productos_unidad_medida_presentacion"
P5 = "id_producto " + PRODUCT
SPREAD = "diferencia_absoluta_max_min diferencia_porcentual_max_min"

MART_COLUMNS = {
    "mart_resumen_general": "fecha_publicacion cantidad_registros_precios cantidad_productos_unicos "
    "cantidad_comercios cantidad_banderas cantidad_sucursales cantidad_provincias cantidad_localidades "
    "precio_promedio_general",
    "mart_evolucion_productos": f"fecha_publicacion {P5} cantidad_registros precio_minimo precio_maximo "
    "precio_promedio precio_referencia_promedio",
    "mart_variacion_productos": f"fecha_publicacion fecha_anterior {P5} precio_promedio_actual "
    "precio_promedio_anterior variacion_absoluta variacion_porcentual cantidad_registros_actual "
    "cantidad_registros_anterior",
    "mart_resumen_productos": "fecha_publicacion id_producto productos_descripcion productos_marca "
    "cantidad_registros cantidad_comercios cantidad_sucursales precio_minimo precio_maximo precio_promedio "
    f"precio_mediano_aproximado {SPREAD}",
    "mart_precios_por_comercio": "fecha_publicacion id_comercio id_bandera comercio_bandera_nombre "
    "cantidad_registros cantidad_productos cantidad_sucursales precio_promedio precio_minimo precio_maximo",
    "mart_precios_por_ubicacion": "fecha_publicacion sucursales_provincia sucursales_localidad "
    "cantidad_registros cantidad_productos cantidad_comercios cantidad_sucursales precio_promedio",
    "mart_promociones": "fecha_publicacion id_producto productos_descripcion productos_marca "
    "cantidad_registros_con_promo1 cantidad_registros_con_promo2 ejemplos_leyendas_promo1 "
    "ejemplos_leyendas_promo2 precio_promedio_lista precio_promedio_promo1 precio_promedio_promo2",
    "mart_productos_mayor_dispersion": "fecha_publicacion id_producto productos_descripcion productos_marca "
    "cantidad_registros cantidad_comercios cantidad_sucursales precio_minimo precio_maximo precio_promedio "
    f"{SPREAD}",
    "mart_sucursales_geografia": "fecha_publicacion id_comercio id_bandera comercio_bandera_nombre id_sucursal "
    "sucursales_nombre sucursales_tipo sucursales_calle sucursales_numero sucursales_localidad "
    "sucursales_provincia sucursales_latitud sucursales_longitud",
    "mart_calidad_precios": "fecha_publicacion cantidad_registros cantidad_precio_nulo cantidad_precio_cero "
    "cantidad_precio_menor_10 precio_minimo precio_maximo precio_promedio",
    "mart_productos_comparables": f"fecha_publicacion {P5} cantidad_registros precio_minimo precio_maximo "
    f"precio_promedio precio_referencia_promedio {SPREAD}",
    "mart_precios_sospechosos": f"fecha_publicacion {P5} productos_precio_lista productos_precio_referencia "
    "regla_calidad",
    "mart_canasta_basica_candidatos": f"fecha_publicacion categoria_canasta {P5} cantidad_registros "
    "precio_minimo precio_maximo precio_promedio precio_referencia_promedio",
}

_DOUBLE_PREFIXES = ("precio", "variacion_", "promedio_", "productos_precio", "sucursales_l")
_DOUBLES = {*SPREAD.split(), "productos_cantidad_presentacion", "diferencia_precio_promedio", "lat", "lon"}
_TEXT = {"sucursales_localidad"}
#: Moves exact halves off the rounding boundary, which the two engines treat differently.
NUDGE = 1e-7


def is_double(column: str) -> bool:
    return column not in _TEXT and (column in _DOUBLES or column.startswith(_DOUBLE_PREFIXES))


def two_decimals(column: str) -> str:
    """Rounded value; a negative zero becomes zero."""
    value = f"round({column} + {NUDGE}, 2)"
    return f"case when {value} = 0 then cast(0 as double) else {value} end"


def cols(text: str, alias: str = "") -> str:
    return ", ".join(f"{alias}{c}" for c in text.split())


def asc(text: str) -> str:
    return ", ".join(f"{c} asc nulls last" for c in text.split())


def same(a: str, b: str, keys: str) -> str:
    return " and ".join(f"{a}.{k} is not distinct from {b}.{k}" for k in keys.split())


_JOIN_S = """left join dim_sucursales s on s.fecha_publicacion = f.fecha_publicacion
    and s.id_comercio = f.id_comercio and s.id_bandera = f.id_bandera and s.id_sucursal = f.id_sucursal"""
_JOIN_C = """left join dim_comercios c on c.fecha_publicacion = f.fecha_publicacion
    and c.id_comercio = f.id_comercio and c.id_bandera = f.id_bandera"""

_BANNER, _BRANCH = "(f.id_comercio, f.id_bandera)", "(f.id_comercio, f.id_bandera, f.id_sucursal)"
_BANNER_TEXT = "f.id_comercio || '-' || f.id_bandera"
_BRANCH_TEXT = _BANNER_TEXT + " || '-' || f.id_sucursal"

_RANGE = """count(*) as cantidad_registros, min(p) as precio_minimo, max(p) as precio_maximo, avg(p) as precio_promedio"""
_SPREAD = """max(p) - min(p) as diferencia_absoluta_max_min,
    case when min(p) > 0 then 100 * (max(p) - min(p)) / min(p) end as diferencia_porcentual_max_min"""


def _product_summary(branch: str, median: bool, having: str = "") -> str:
    middle = "quantile_disc(p, 0.5) as precio_mediano_aproximado," if median else ""
    return f"""select f.fecha_publicacion, f.id_producto, min(productos_descripcion) as productos_descripcion,
    min(productos_marca) as productos_marca, count(distinct f.id_comercio) as cantidad_comercios,
    count(distinct {branch}) as cantidad_sucursales, {middle} {_RANGE}, {_SPREAD}
    from con_precio f group by all {having}"""


def _by_chain(branch: str) -> str:
    return f"""select f.fecha_publicacion, f.id_comercio, f.id_bandera,
    min(c.comercio_bandera_nombre) as comercio_bandera_nombre, count(distinct f.id_producto) as cantidad_productos,
    count(distinct {branch}) as cantidad_sucursales, {_RANGE} from con_precio f {_JOIN_C} group by all"""


def _by_place(branch: str) -> str:
    return f"""select f.fecha_publicacion, s.sucursales_provincia, s.sucursales_localidad,
    count(*) as cantidad_registros, count(distinct f.id_producto) as cantidad_productos,
    count(distinct f.id_comercio) as cantidad_comercios, count(distinct {branch}) as cantidad_sucursales,
    avg(p) as precio_promedio from con_precio f {_JOIN_S} group by all"""


def _summary(banner: str, branch: str) -> str:
    return f"""select f.fecha_publicacion, count(*) as cantidad_registros_precios,
    count(distinct f.id_producto) as cantidad_productos_unicos, count(distinct f.id_comercio) as cantidad_comercios,
    count(distinct {banner}) as cantidad_banderas, count(distinct {branch}) as cantidad_sucursales,
    count(distinct s.sucursales_provincia) as cantidad_provincias,
    count(distinct s.sucursales_localidad) as cantidad_localidades,
    avg(f.productos_precio_lista) as precio_promedio_general from fact_precios f {_JOIN_S} group by all"""


def _category(keywords) -> str:
    cases = " ".join(f"when contains(lower(productos_descripcion), '{k.lower()}') then '{k}'" for k in keywords)
    return f"case {cases} end"


def marts_sql(keywords) -> dict[str, str]:
    comparable = f"""select fecha_publicacion, {cols(P5)}, {_RANGE},
        avg(productos_precio_referencia) as precio_referencia_promedio, {_SPREAD} from con_precio group by all"""
    return {
        "mart_resumen_general": _summary(_BANNER, _BRANCH),
        "mart_evolucion_productos": f"select {cols(MART_COLUMNS['mart_evolucion_productos'])} from ({comparable})",
        "mart_variacion_productos": f"""select a.fecha_publicacion, b.fecha_publicacion as fecha_anterior,
            {cols(P5, 'a.')}, a.precio_promedio as precio_promedio_actual,
            b.precio_promedio as precio_promedio_anterior,
            a.precio_promedio - b.precio_promedio as variacion_absoluta,
            case when b.precio_promedio > 0
                then 100 * (a.precio_promedio - b.precio_promedio) / b.precio_promedio end as variacion_porcentual,
            a.cantidad_registros as cantidad_registros_actual, b.cantidad_registros as cantidad_registros_anterior
            from mart_evolucion_productos a join mart_evolucion_productos b
            on a.id_producto = b.id_producto and {same('a', 'b', PRODUCT)}
            and b.fecha_publicacion < a.fecha_publicacion
            qualify row_number() over (partition by a.fecha_publicacion, {cols(P5, 'a.')}
                order by b.fecha_publicacion desc) = 1""",
        "mart_resumen_productos": _product_summary(_BRANCH, True),
        "mart_precios_por_comercio": _by_chain(_BRANCH),
        "mart_precios_por_ubicacion": _by_place(_BRANCH),
        "mart_promociones": """select fecha_publicacion, id_producto, min(productos_descripcion) as productos_descripcion,
            min(productos_marca) as productos_marca,
            count(productos_precio_unitario_promo1) as cantidad_registros_con_promo1,
            count(productos_precio_unitario_promo2) as cantidad_registros_con_promo2,
            string_agg(distinct l1, ' | ' order by l1) as ejemplos_leyendas_promo1,
            string_agg(distinct l2, ' | ' order by l2) as ejemplos_leyendas_promo2,
            avg(productos_precio_lista) as precio_promedio_lista,
            avg(productos_precio_unitario_promo1) as precio_promedio_promo1,
            avg(productos_precio_unitario_promo2) as precio_promedio_promo2
            from (select *, nullif(productos_leyenda_promo1, '') as l1, nullif(productos_leyenda_promo2, '') as l2
                  from fact_precios) x
            where coalesce(productos_precio_unitario_promo1, productos_precio_unitario_promo2) is not null
               or coalesce(l1, l2) is not null group by all""",
        "mart_productos_mayor_dispersion": _product_summary(_BRANCH, False, "having count(*) >= 20"),
        "mart_sucursales_geografia": f"""select f.*, c.comercio_bandera_nombre from dim_sucursales f {_JOIN_C}
            where f.sucursales_latitud + f.sucursales_longitud is not null""",
        "mart_calidad_precios": """select fecha_publicacion, count(*) as cantidad_registros,
            count(*) - count(productos_precio_lista) as cantidad_precio_nulo,
            count(case when productos_precio_lista = 0 then 1 end) as cantidad_precio_cero,
            count(case when productos_precio_lista > 0 and productos_precio_lista < 10 then 1 end)
                as cantidad_precio_menor_10,
            min(productos_precio_lista) as precio_minimo, max(productos_precio_lista) as precio_maximo,
            avg(productos_precio_lista) as precio_promedio from fact_precios group by all""",
        "mart_productos_comparables": comparable,
        "mart_precios_sospechosos": f"""select fecha_publicacion, {cols(P5)}, productos_precio_lista,
            productos_precio_referencia, case when p >= 100000 then 'precio_muy_alto' when p > 0 then 'precio_menor_10'
                else 'precio_menor_o_igual_cero' end as regla_calidad
            from con_precio where p < 10 or p >= 100000""",
        "mart_canasta_basica_candidatos": f"""select * from (select {_category(keywords)} as categoria_canasta, *
            from mart_evolucion_productos) x where categoria_canasta is not null""",
    }


def saved_sql(name: str) -> str:
    """Variants of marts that compare concatenated keys."""
    return {
        "a1": _summary(_BANNER_TEXT, _BRANCH_TEXT),
        "a2": _product_summary(_BRANCH_TEXT, True),
        "a3": _by_chain(_BRANCH_TEXT),
        "a4": _by_place(_BRANCH_TEXT),
        "a6": _product_summary(_BRANCH_TEXT, False, "having count(*) >= 20"),
    }[name]


def joined(select: str, where: str) -> str:
    return f"select {select} from fact_precios f {_JOIN_C} {_JOIN_S} where {where}"


_ORDER = list(MART_COLUMNS)
_NEEDS = {
    "mart_variacion_productos": ("mart_evolucion_productos",),
    "mart_canasta_basica_candidatos": ("mart_evolucion_productos",),
}


def compose(body: str, columns: str, keywords) -> str:
    """A complete statement: the views and marts the body mentions, then the body with rounded doubles."""
    all_marts = marts_sql(keywords)
    wanted = [m for m in _ORDER if m in body]
    wanted = [m for m in _ORDER if m in wanted or any(m in _NEEDS.get(w, ()) for w in wanted)]
    used = body + " ".join(all_marts[m] for m in wanted)
    parts = []
    if "fact_precios" in used or "con_precio" in used:
        parts.append(f"fact_precios as ({views.plain(views.FACT_PRECIOS)})")
    if "con_precio" in used:
        parts.append(
            "con_precio as (select *, productos_precio_lista as p from fact_precios "
            "where productos_precio_lista is not null)"
        )
    parts += [f"{d} as ({views.plain(views.STAR[d])})" for d in ("dim_comercios", "dim_sucursales") if d in used]
    if "recursos" in used:
        parts.append(f"recursos as ({views.plain(views.RECURSOS)})")
    if "textos" in used:
        parts.append(f"textos as ({views.plain(views.TEXTOS)})")
    parts += [f"{m} as ({all_marts[m]})" for m in wanted]
    shown = ", ".join(f"{two_decimals(c)} as {c}" if is_double(c) else c for c in columns.split())
    prefix = "with " + ",\n".join(parts) + "\n" if parts else ""
    return f"{prefix}select {shown} from ({body}) resultado"
