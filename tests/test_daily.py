"""The daily job: marts renewed date by date equal those of one full build."""

import re
import shutil

import pytest
from pyspark.sql import functions as F

from gondola.plans import freshness, ingest
from gondola.plans.build import MARTS, build_marts
from gondola.plans.daily import load_entries, run_daily
from gondola.schemas import FACT
from gondola.sources import replacement
from gondola.sources.tables import Warehouse
from tests import archive_data as data


def archive(tmp_path, name, day, *products):
    prices = [data.price(p, amount=str(100.0 + 7 * i + len(name))) for i, p in enumerate(products)]
    return data.write_archive(tmp_path / name, {f"{day}/m.zip": data.simple_member(*prices, branches=2)})


def rows(warehouse):
    return {name: sorted(map(str, warehouse.read(name).collect())) for name in MARTS}


def test_daily_runs_equal_a_full_build(spark, tmp_path):
    entries = [
        (None, archive(tmp_path, "a.zip", "2026-05-20", "leche", "b", "c")),
        (None, archive(tmp_path, "dd.zip", "2026-05-24", "leche", "b", "d")),
        # Between dates that are there already: later changes are against another date now.
        (None, archive(tmp_path, "ccc.zip", "2026-05-22", "b", "c", "d")),
    ]
    daily, whole = (Warehouse(spark, str(tmp_path / n)) for n in ("diario", "entero"))
    for entry in entries:
        result = run_daily(daily, [entry])
        assert result["tablas"][FACT] == 3 and set(result["marts"]) == set(MARTS)
    again = (None, archive(tmp_path, "eeee.zip", "2026-05-22", "leche"))
    run_daily(daily, [again], reload_existing=True)
    assert run_daily(daily, [again])["marts"] == {}
    ingest.load_archives(whole, [*entries[:2], again])
    build_marts(whole)
    assert rows(daily) == rows(whole)


class Stopped(Exception):
    pass


def test_a_plain_retry_renews_what_a_dead_build_left_stale(spark, tmp_path, monkeypatch):
    """A build that dies before any mart, or in the middle of replacing it, is mended by the same call, which loads nothing."""
    first, second = (archive(tmp_path, f"{n}.zip", day, *products) for n, day, products in (("a", "2026-05-20", "leche b"), ("b", "2026-05-22", "leche")))
    again = archive(tmp_path, "ccc.zip", "2026-05-20", "leche", "z")
    whole = Warehouse(spark, str(tmp_path / "entero"))
    ingest.load_archives(whole, [(None, second), (None, again)])
    build_marts(whole)
    wanted = rows(whole)
    built = Warehouse(spark, str(tmp_path / "hecho"))
    run_daily(built, [(None, first), (None, second)])
    stage, move = replacement.Replacement.stage, replacement.move
    for name, dies_moving in (("mart_evolucion_productos", True), ("mart_variacion_productos", False)):
        daily = Warehouse(spark, str(tmp_path / name))
        shutil.copytree(built.root, daily.root)
        at = []

        def stopping(self, table, *args, name=name, dies_moving=dies_moving, at=at, **kwargs):
            at[:] = [table]
            if table == name and not dies_moving:
                raise Stopped
            return stage(self, table, *args, **kwargs)

        def stopping_move(system, source, target, name=name, dies_moving=dies_moving, at=at):
            if dies_moving and at == [name] and target.endswith(".parquet"):
                raise Stopped
            move(system, source, target)

        with monkeypatch.context() as patch:
            patch.setattr(replacement.Replacement, "stage", stopping)
            patch.setattr(replacement, "move", stopping_move)
            with pytest.raises(Stopped):
                run_daily(daily, [(None, again)], reload_existing=True)
        found = run_daily(daily, [(None, again)])
        assert found["tablas"][FACT] == 0
        # One that died while its files were moved is finished without being built again.
        assert set(found["marts"]) == set(list(MARTS)[list(MARTS).index(name) + dies_moving :])
        assert rows(daily) == wanted
        assert freshness.stale(daily, MARTS) == {}


def test_dates_loaded_before_there_was_a_ledger_are_built(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "almacen"))
    ingest.load_archives(warehouse, [(None, archive(tmp_path, "a.zip", "2026-05-20", "leche"))])
    build_marts(warehouse)
    replacement.delete_folder(warehouse.path(freshness.FOLDER))
    assert set(freshness.stale(warehouse, MARTS)) == set(MARTS)
    assert set(run_daily(warehouse, [])["marts"]) == set(MARTS)
    assert freshness.stale(warehouse, MARTS) == {}


def test_marts_of_a_date_scan_its_partition_only(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "almacen"))
    for i, day in enumerate(("2026-05-20", "2026-05-21")):
        ingest.load_archives(warehouse, [(None, archive(tmp_path, f"{i}.zip", day, "a", "b"))])
    days = warehouse.dates(FACT)
    pruned = warehouse.base().precios.where(F.col("fecha_publicacion").isin(days[1:]))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*fecha_publicacion", plan)
    assert warehouse.dates("nichts") == []


def test_entries_of_chosen_resources(spark):
    chosen = spark.sql("select date'2026-05-21' as fecha union all select date'2026-05-20' union all select null")
    assert load_entries(chosen, "/raw/{fecha}.zip") == [("2026-05-20", "/raw/2026-05-20.zip"), ("2026-05-21", "/raw/2026-05-21.zip")]


def test_dates_need_marts(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "almacen"))
    ingest.load_archives(warehouse, [(None, archive(tmp_path, "a.zip", "2026-05-20", "a"))])
    with pytest.raises(RuntimeError):
        build_marts(warehouse, dates=warehouse.dates(FACT))
    assert build_marts(warehouse, dates=[]) == {}
