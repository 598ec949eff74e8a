"""Marts against brute force and against each other, with duplicated and missing dimension rows, NULL keys,
and a product that holds a third of all prices."""

import datetime
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks.registry import Context
from gondola.operators.variation import against_previous_date
from gondola.operators import aggregates
from gondola.plans import dashboard, marts
from gondola.plans import saved_queries as q
from gondola.plans.build import MARTS, MartSources, build_marts, marts_to_build
from gondola.schemas import BRANCHES, CHAINS, COMPARABLE_PRODUCT, DATE, FACT, PRICE, TABLES, BaseTables
from gondola.sources.tables import Warehouse

DAYS = [datetime.date(2026, 5, d) for d in (20, 21, 23)]


def price_rows():
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        hot = i % 3 == 0
        product = "caliente" if hot else rng.choice(["p1", "p2", "p3", None])
        rows.append(
            {
                DATE: rng.choice([*DAYS, None]) if i % 40 == 0 else rng.choice(DAYS),
                "id_comercio": rng.choice(["1", "2", None]),
                "id_bandera": rng.choice(["1", "2"]),
                "id_sucursal": rng.choice(["1", "2", "3", None]),
                "id_producto": product,
                "productos_descripcion": rng.choice(["LECHE entera", "Arroz con leche", None]),
                "productos_marca": rng.choice(["m", None]),
                "productos_cantidad_presentacion": rng.choice([1.0, None]),
                "productos_unidad_medida_presentacion": rng.choice(["kg", "lt"]),
                PRICE: rng.choice([None, 0.0, -1.0, 5.0, 250_000.0, *[float(rng.randint(10, 500)) for _ in range(9)]]),
                "productos_precio_referencia": rng.choice([None, 3.0]),
                "productos_precio_unitario_promo1": rng.choice([None, 2.0]),
                "productos_leyenda_promo1": rng.choice([None, "", "b", "a"]),
                "productos_precio_unitario_promo2": None,
                "productos_leyenda_promo2": rng.choice([None, ""]),
            }
        )
    return rows


ROWS = price_rows()
BRANCH_ROWS = [
    {DATE: day, "id_comercio": c, "id_bandera": b, "id_sucursal": s, "sucursales_provincia": p, "sucursales_localidad": loc}
    for day in DAYS
    for c, b, s, p, loc in (
        ("1", "1", "1", "P", "L1"),
        ("1", "1", "1", "P", "L1"),  # listed twice
        ("1", "1", "2", "P", "L2"),
        ("1", "1", "2", "Q", "L3"),  # at two places
        ("2", "1", "1", None, None),
    )
]
CHAIN_ROWS = [
    {DATE: day, "id_comercio": "1", "id_bandera": "1", "comercio_bandera_nombre": n} for day in DAYS for n in ("Z", "A")
]


@pytest.fixture(scope="module")
def base(spark):
    def frame(table, rows):
        schema = TABLES[table].schema
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema).repartition(5)

    return BaseTables(frame(FACT, ROWS), frame(CHAINS, CHAIN_ROWS), frame(BRANCHES, BRANCH_ROWS))


@pytest.fixture(scope="module")
def sources(base):
    return MartSources(base)


def joined(keys, dimension):
    """Price rows with their dimension rows, as a left join gives them."""
    for row in ROWS:
        key = tuple(row[k] for k in keys)
        matches = [d for d in dimension if None not in key and tuple(d[k] for k in keys) == key]
        for match in matches or [{}]:
            yield row, match


def close(a, b):
    return (a is None and b is None) or a == pytest.approx(b)


BRANCH = (DATE, "id_comercio", "id_bandera", "id_sucursal")


def test_general_summary_keeps_the_join_fan_out(sources):
    groups = defaultdict(list)
    for row, place in joined(BRANCH, BRANCH_ROWS):
        groups[row[DATE]].append((row, place))
    found = {r[DATE]: r for r in sources.mart("mart_resumen_general").collect()}
    assert set(found) == set(groups)
    for day, pairs in groups.items():
        prices = [r[PRICE] for r, _ in pairs if r[PRICE] is not None]
        got = found[day]
        assert got["cantidad_registros_precios"] == len(pairs)
        assert got["cantidad_productos_unicos"] == len({r["id_producto"] for r, _ in pairs} - {None})
        assert got["cantidad_comercios"] == len({r["id_comercio"] for r, _ in pairs} - {None})
        assert got["cantidad_banderas"] == len({(r["id_comercio"], r["id_bandera"]) for r, _ in pairs})
        assert got["cantidad_sucursales"] == len({tuple(r[k] for k in BRANCH) for r, _ in pairs})
        assert got["cantidad_localidades"] == len({p.get("sucursales_localidad") for _, p in pairs} - {None})
        assert close(got["precio_promedio_general"], statistics.fmean(prices))


def test_places_with_null_group(sources):
    groups = defaultdict(list)
    for row, place in joined(BRANCH, BRANCH_ROWS):
        if row[PRICE] is not None:
            groups[row[DATE], place.get("sucursales_provincia"), place.get("sucursales_localidad")].append(row)
    found = {tuple(r)[:3]: r for r in sources.mart("mart_precios_por_ubicacion").collect()}
    assert set(found) == set(groups)
    for key, rows in groups.items():
        got = found[key]
        assert got["cantidad_registros"] == len(rows)
        assert got["cantidad_productos"] == len({r["id_producto"] for r in rows} - {None})
        assert got["cantidad_comercios"] == len({r["id_comercio"] for r in rows} - {None})
        assert got["cantidad_sucursales"] == len({tuple(r[k] for k in BRANCH[1:]) for r in rows})
        assert close(got["precio_promedio"], statistics.fmean(r[PRICE] for r in rows))


def test_chains_with_null_keys(sources):
    groups = defaultdict(list)
    names = defaultdict(set)
    for row, chain in joined(BRANCH[:3], CHAIN_ROWS):
        if row[PRICE] is not None:
            key = tuple(row[k] for k in BRANCH[:3])
            groups[key].append(row)
            names[key] |= {chain.get("comercio_bandera_nombre")} - {None}
    found = {tuple(r)[:3]: r for r in sources.mart("mart_precios_por_comercio").collect()}
    assert set(found) == set(groups)
    for key, rows in groups.items():
        got = found[key]
        assert got["comercio_bandera_nombre"] == min(names[key], default=None)
        assert got["cantidad_registros"] == len(rows)
        assert got["cantidad_productos"] == len({r["id_producto"] for r in rows} - {None})
        assert got["cantidad_sucursales"] == len({r["id_sucursal"] for r in rows})
        assert got["precio_minimo"] == min(r[PRICE] for r in rows)


def test_products(sources):
    groups = defaultdict(list)
    for row in ROWS:
        if row[PRICE] is not None:
            groups[row[DATE], row["id_producto"]].append(row)
    found = {tuple(r)[:2]: r for r in sources.mart("mart_resumen_productos").collect()}
    assert set(found) == set(groups)
    for key, rows in groups.items():
        got, prices = found[key], sorted(r[PRICE] for r in rows)
        assert got["cantidad_registros"] == len(rows)
        assert got["cantidad_comercios"] == len({r["id_comercio"] for r in rows} - {None})
        assert got["cantidad_sucursales"] == len({tuple(r[k] for k in BRANCH[1:]) for r in rows})
        assert got["precio_mediano_aproximado"] == prices[(len(prices) - 1) // 2]
        assert close(got["precio_promedio"], statistics.fmean(prices))
        low = prices[0]
        assert close(got["diferencia_porcentual_max_min"], (prices[-1] - low) / low * 100 if low > 0 else None)


def test_products_with_concatenated_keys_skip_nulls(sources):
    groups = defaultdict(set)
    for row in ROWS:
        if row[PRICE] is not None:
            key = tuple(row[k] for k in BRANCH[1:])
            groups[row[DATE], row["id_producto"]] |= {key} if None not in key else set()
    frame = q.product_summary(sources.comparables, sources.by_banner, sources.base.precios)
    found = {tuple(r)[:2]: r["cantidad_sucursales"] for r in frame.collect()}
    assert found == {key: len(keys) for key, keys in groups.items()}


def test_promotions(sources):
    legends = defaultdict(set)
    for row in ROWS:
        if row["productos_precio_unitario_promo1"] is not None or row["productos_leyenda_promo1"]:
            legends[row[DATE], row["id_producto"]] |= {row["productos_leyenda_promo1"]} - {None, ""}
    found = {tuple(r)[:2]: r for r in sources.mart("mart_promociones").collect()}
    assert {k: r["ejemplos_leyendas_promo1"] for k, r in found.items()} == {
        k: " | ".join(sorted(v)) or None for k, v in legends.items()
    }
    assert {r["ejemplos_leyendas_promo2"] for r in found.values()} == {None}


def test_quality_buckets(sources):
    got = {r[DATE]: r for r in sources.mart("mart_calidad_precios").collect()}
    for day in DAYS:
        prices = [r[PRICE] for r in ROWS if r[DATE] == day]
        assert got[day]["cantidad_precio_nulo"] == prices.count(None)
        assert got[day]["cantidad_precio_cero"] == prices.count(0.0)
        assert got[day]["cantidad_precio_menor_10"] == prices.count(5.0)


def test_variation_equals_the_self_join(sources):
    evolution = sources.mart("mart_evolucion_productos")
    rows = [r for r in evolution.collect() if r["id_producto"] is not None and r[DATE] is not None]
    by_key = defaultdict(dict)
    for r in rows:
        by_key[tuple(r[c] for c in COMPARABLE_PRODUCT)][r[DATE]] = r
    expected = {}
    for key, series in by_key.items():
        for day, r in series.items():
            earlier = [d for d in series if d < day]
            if earlier:
                expected[(day, *key)] = (max(earlier), series[max(earlier)]["precio_promedio"])
    got = {
        (r[DATE], *[r[c] for c in COMPARABLE_PRODUCT]): (r["fecha_anterior"], r["precio_promedio_anterior"])
        for r in against_previous_date(evolution).collect()
    }
    assert got == expected and got


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_mart_identities(sources):
    products = sources.mart("mart_resumen_productos").where("cantidad_registros >= 20").drop("precio_mediano_aproximado")
    assert same_rows(sources.mart("mart_productos_mayor_dispersion"), products)
    spread = ["diferencia_absoluta_max_min", "diferencia_porcentual_max_min"]
    evolution = sources.mart("mart_evolucion_productos")
    assert same_rows(evolution, sources.mart("mart_productos_comparables").drop(*spread))
    basket = sources.mart("mart_canasta_basica_candidatos")
    described = evolution.where("productos_descripcion is not null")
    assert same_rows(basket.drop("categoria_canasta"), described)
    # The first keyword wins: rice with milk is milk.
    assert {r[0] for r in basket.select("categoria_canasta").distinct().collect()} == {"LECHE"}


def test_suspicious_labels(sources):
    found = {(r[PRICE], r["regla_calidad"]) for r in sources.mart("mart_precios_sospechosos").collect()}
    assert found == {
        (-1.0, "precio_menor_o_igual_cero"),
        (0.0, "precio_menor_o_igual_cero"),
        (5.0, "precio_menor_10"),
        (250_000.0, "precio_muy_alto"),
    }


def test_every_date_with_a_flagged_price_is_stored(spark):
    context = Context(spark, "/root/testdata/sf0.1")
    price = F.col("productos_precio_lista")
    flagged = context.sources.base.precios.where((price < 10) | (price >= 100_000)).groupBy("fecha_publicacion").count()
    wanted = {r.fecha_publicacion: r["count"] for r in flagged.collect()}
    mart = marts.precios_sospechosos(context.sources.base.precios)
    found = {r.fecha_publicacion: r["count"] for r in mart.groupBy("fecha_publicacion").count().collect()}
    assert found == wanted and sum(found.values()) > 10_000
    for when in sorted(found)[:2] + sorted(found)[-1:]:
        assert dashboard.suspicious_rows(mart, when).count() == found[when]


def test_series_over_more_than_500_dates(spark):
    dates = spark.range(501).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("fecha_publicacion"),
        F.lit("1").alias("id_producto"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("productos_descripcion", "string"), ("productos_marca", "string"))],
        F.lit(None).cast("double").alias("productos_cantidad_presentacion"),
        F.lit(None).cast("string").alias("productos_unidad_medida_presentacion"),
        F.lit(1).alias("cantidad_registros"),
        *[(F.col("id") + 1.0).alias(c) for c in ("precio_minimo", "precio_maximo", "precio_promedio")],
        F.lit(1.0).alias("precio_referencia_promedio"),
    )
    series = dashboard.product_series(dates, "1", None, None, None, None)
    assert series.count() == 501 and dashboard.series_by_metric(series).count() == 1503
    change = dashboard.series_change(series).first()
    assert (change.promedio_inicial, change.promedio_final) == (1.0, 501.0)


def test_find_products_weighs_the_fan_out(base):
    rows = defaultdict(list)
    for row, place in joined(BRANCH, BRANCH_ROWS):
        text = (row["productos_descripcion"] or "").lower()
        if row[PRICE] is not None and "leche" in text and place.get("sucursales_provincia") == "P":
            rows[(row[DATE], *[row[c] for c in COMPARABLE_PRODUCT])].append(row[PRICE])
    found = q.find_products(base, "leche", province="P", limit=1000).collect()
    got = {(r[DATE], *[r[c] for c in COMPARABLE_PRODUCT]): (r["cantidad_registros"], r["precio_promedio"]) for r in found}
    assert got == {k: (len(v), pytest.approx(statistics.fmean(v))) for k, v in rows.items()} and got


def test_full_build_equals_direct_marts(spark, base, sources, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    with pytest.raises(RuntimeError, match="dim_comercios, dim_sucursales, fact_precios"):
        build_marts(warehouse)
    warehouse.create_base()
    for table, frame in ((CHAINS, base.comercios), (BRANCHES, base.sucursales), (FACT, base.precios)):
        warehouse.append(table, frame)
    rows = build_marts(warehouse, output=str(tmp_path / "salida"))
    assert list(rows) == list(MARTS)
    for name, count in rows.items():
        written, direct = warehouse.read(name), sources.mart(name)
        assert written.columns == direct.columns
        assert written.count() == count == direct.count()
        doubles = [c for c, kind in direct.dtypes if kind == "double"]
        shown = {c: F.round(F.col(c) + 1e-7, 4) for c in doubles}
        assert same_rows(written.withColumns(shown), direct.withColumns(shown)), name
    exported = spark.read.option("header", True).csv(str(tmp_path / "salida" / "mart_calidad_precios.csv"))
    assert exported.count() == rows["mart_calidad_precios"]


def test_an_empty_mart_can_be_read(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.create_base()
    assert build_marts(warehouse, only="mart_variacion_productos") == {
        "mart_evolucion_productos": 0,
        "mart_variacion_productos": 0,
    }
    assert warehouse.read("mart_variacion_productos").columns[:2] == [DATE, "fecha_anterior"]


def test_dependencies():
    assert marts_to_build("mart_variacion_productos") == ["mart_evolucion_productos", "mart_variacion_productos"]
    assert marts_to_build("mart_promociones") == ["mart_promociones"]
    assert marts_to_build() == list(MARTS) and len(MARTS) == 13
    with pytest.raises(ValueError):
        marts_to_build("otro")


def test_keywords_can_be_chosen(sources):
    found = marts.canasta_basica_candidatos(sources.mart("mart_evolucion_productos"), ["ARROZ"])
    assert {r[0] for r in found.select("productos_descripcion").distinct().collect()} == {"Arroz con leche"}


@pytest.mark.parametrize("name", ["mart_resumen_general", "mart_precios_por_ubicacion", "mart_sucursales_geografia"])
def test_results_do_not_depend_on_broadcasting(spark, base, sources, name):
    """Beyond the broadcast threshold the same joins run as shuffle joins."""
    expected = sources.mart(name).collect()
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for setting in settings:
            spark.conf.set(setting, "-1")
        found = MartSources(base).mart(name)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        key = lambda row: tuple(str(v) for v in row[:5])
        for a, b in zip(sorted(expected, key=key), sorted(found.collect(), key=key), strict=True):
            assert all(close(x, y) if isinstance(x, float) else x == y for x, y in zip(a, b))
    finally:
        for setting in settings:
            spark.conf.unset(setting)


def test_branches_of_any_id_are_counted_once(spark):
    """Numbers, numbers that are written otherwise, texts, NULL; prices or none; a product with most of all rows."""
    ids = ["1", "01", "63", "64", "65", "128", "-3", "+4", " 7", "x", "", "9" * 18, "9" * 30, "1.0", None]
    rows = []
    for i in range(3000):
        day, chain, banner = None if i % 50 == 0 else "2026-05-20", "1" if i % 3 else None, str(i % 2)
        product = "hot" if i % 4 else None if i % 8 else f"p{i % 40}"
        rows.append((day, chain, banner, product, ids[i * 7 % len(ids)], None if i % 5 == 0 else 1.0 + i))
    prices = spark.createDataFrame(rows, f"{DATE} string, id_comercio string, id_bandera string, id_producto string, id_sucursal string, {PRICE} double")
    wanted = {}
    for *key, branch, price in rows:
        n, seen, blank = wanted.setdefault(tuple(key), [0, set(), 0])
        if price is not None:
            wanted[tuple(key)] = [n + 1, seen | ({branch} - {None}), max(blank, branch is None)]
    got = {tuple(r[:4]): tuple(r[4:]) for r in aggregates.product_by_banner(aggregates.product_branches(prices)).collect()}
    assert got == {k: (n, len(seen), blank) for k, (n, seen, blank) in wanted.items()}


def test_no_price_is_shuffled_before_it_is_aggregated(base):
    s = MartSources(base)
    for frame in (s.activity, s.branches, s.by_banner, s.comparables):
        plan = frame._jdf.queryExecution().executedPlan().toString().splitlines()
        # The fixture deals its few rows out itself.
        lines = [line for line in plan if ("Exchange" in line or "Aggregate" in line) and "RoundRobin" not in line]
        # From the leaves: the first step is a partial aggregate of the map tasks.
        assert "HashAggregate" in lines[-1] and "partial_" in lines[-1]


def test_products_at_places_of_any_branch(spark):
    """Branches at several places, at none, of ids that are no numbers, with NULL parts of the key; against a plain join."""
    ids = ["1", "01", "63", "64", "65", "x", "", "9" * 30, None]
    day = "2026-05-20"
    places = [(day if i % 9 else None, "1", str(i % 2), ids[i * 5 % len(ids)], f"P{i % 3}" if i % 4 else None, f"L{i % 5}", 1) for i in range(60)]
    prices = [
        (day if i % 40 else None, "1" if i % 30 else None, str(i % 3), f"p{i % 7}" if i % 25 else None, ids[i * 7 % len(ids)], None if i % 5 == 0 else 1.0) for i in range(700)
    ]
    key = f"{DATE} string, id_comercio string, id_bandera string"
    sold = spark.createDataFrame(prices, f"{key}, id_producto string, id_sucursal string, {PRICE} double")
    located = spark.createDataFrame(places, f"{key}, id_sucursal string, sucursales_provincia string, sucursales_localidad string, veces int")
    columns = [DATE, "sucursales_provincia", "sucursales_localidad", "id_producto"]
    got = aggregates.products_at_places(aggregates.product_branches(sold), located).select(columns).distinct()
    joined_keys = [DATE, "id_comercio", "id_bandera", "id_sucursal"]
    wanted = sold.where(F.col(PRICE).isNotNull()).join(located, joined_keys, "left").select(columns).distinct()
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in wanted.collect()}


def test_no_row_expansion_on_the_price_table(base):
    """Distinct counts of single prices are planned without multiplying the rows, texts without sorting them."""
    s = MartSources(base)
    for frame in (s.activity, s.by_banner, s.comparables):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "SortAggregate" not in plan
