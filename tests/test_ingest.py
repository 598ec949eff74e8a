"""Loading archives: skipping, reloading, replacing, warnings and failures."""

import datetime
import json
import shutil
import zipfile

import pytest

from gondola.plans import ingest
from gondola.plans.inspect import inspect_archives
from gondola.schemas import BRANCHES, CHAINS, DATE, FACT
from gondola.sources import replacement
from gondola.sources.tables import Warehouse
from tests import archive_data as data

DAY = datetime.date(2026, 5, 23)


def states(warehouse):
    rows = ingest.control_table(warehouse).orderBy("started_at").collect()
    return [r["estado"] for r in rows]


def rows_of(warehouse):
    return {t: warehouse.read(t).count() for t in (CHAINS, BRANCHES, FACT)}


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "almacen"))


def simple(tmp_path, name, day="2026-05-23", *products, branches=1):
    prices = [data.price(p) for p in products or ("a", "b")]
    return data.write_archive(tmp_path / name, {f"{day}/m.zip": data.simple_member(*prices, branches=branches)})


def test_load_with_warnings(warehouse, tmp_path):
    archive = data.full_archive(tmp_path / "diario.zip")
    counts = ingest.load_archives(warehouse, [(None, archive)])
    # Members with an unknown header or an unreadable file are left out as a whole.
    assert counts == {CHAINS: 7, BRANCHES: 6, FACT: 15} == rows_of(warehouse)
    record = ingest.control_table(warehouse).first()
    assert record["estado"] == "success_with_warnings" and record["modo_carga"] == "append"
    assert json.loads(record["fechas_publicacion"]) == ["2026-05-23"]
    assert record["filas_fact_precios"] == 15 and record["finished_at"] >= record["started_at"]
    messages = json.loads(record["detalle"])["errores"]
    assert record["errores"] == len(messages) == 5
    assert "2026-05-23/cadena_6.zip: falta sucursales.csv" in messages
    assert "2026-05-23/cadena_7.zip: ValueError: ZIP interno vacio." in messages
    assert "2026-05-23/cadena_8.zip: ZIP interno corrupto." in messages
    assert any(m.startswith("2026-05-23/cadena_11.zip: UnicodeDecodeError") for m in messages)


def test_second_load_is_skipped_and_undated_members_repeat(warehouse, tmp_path):
    archive = data.write_archive(
        tmp_path / "a.zip",
        {
            "2026-05-23/m.zip": data.simple_member(data.price("a")),
            "sin_fecha.zip": data.simple_member(data.price("b")),
        },
    )
    ingest.load_archives(warehouse, [(None, archive)])
    assert ingest.load_archives(warehouse, [(None, archive)])[FACT] == 1
    assert warehouse.read(FACT).count() == 3
    dated = simple(tmp_path, "b.zip")
    assert ingest.load_archives(warehouse, [(None, dated)]) == {CHAINS: 0, BRANCHES: 0, FACT: 0}
    assert states(warehouse)[-1] == "skipped"
    detail = json.loads(ingest.control_table(warehouse).where("estado = 'skipped'").first()["detalle"])
    assert detail["detalle"] == "Fechas ya cargadas; no se insertaron filas nuevas."


def test_members_of_one_new_date_all_load(warehouse, tmp_path):
    archive = data.write_archive(
        tmp_path / "a.zip",
        {f"2026-05-23/m{i}.zip": data.simple_member(data.price(str(i))) for i in range(3)},
    )
    assert ingest.load_archives(warehouse, [(None, archive)]) == {CHAINS: 3, BRANCHES: 3, FACT: 3}


def test_reload_replaces_dates_in_all_tables(warehouse, tmp_path):
    ingest.load_archives(warehouse, [(None, simple(tmp_path, "a.zip", branches=3))])
    ingest.load_archives(warehouse, [(None, simple(tmp_path, "c.zip", "2026-05-24"))])
    again = simple(tmp_path, "b.zip", "2026-05-23", "x")
    ingest.load_archives(warehouse, [(None, again)], reload_existing=True)
    found = {(r["fecha_publicacion"].isoformat(), r["id_producto"]) for r in warehouse.read(FACT).collect()}
    assert found == {("2026-05-23", "x"), ("2026-05-24", "a"), ("2026-05-24", "b")}
    assert warehouse.read(BRANCHES).where("fecha_publicacion = '2026-05-23'").count() == 1


def test_reload_keeps_dates_whose_new_archive_is_unreadable(warehouse, tmp_path):
    ingest.load_archives(warehouse, [(None, simple(tmp_path, "a.zip"))])
    before = rows_of(warehouse)
    broken = data.write_archive(tmp_path / "b.zip", {"2026-05-23/m.zip": b"roto"})
    ingest.load_archives(warehouse, [(None, broken)], reload_existing=True)
    assert rows_of(warehouse) == before and warehouse.dates(FACT) == [DAY]


class Stopped(Exception):
    pass


def test_a_load_that_stops_anywhere_leaves_old_rows_or_new_ones(spark, tmp_path, monkeypatch):
    """Before steps of staging, agreeing, deleting and moving: readers see the one or the other, a plain retry mends the load."""
    loaded = Warehouse(spark, str(tmp_path / "cargado"))
    ingest.load_archives(loaded, [(None, simple(tmp_path, "otro.zip", "2026-05-22")), (None, simple(tmp_path, "viejo.zip", branches=3))])
    before, after = {CHAINS: 2, BRANCHES: 4, FACT: 4}, {CHAINS: 2, BRANCHES: 3, FACT: 3}
    assert rows_of(loaded) == before
    entry = [(None, simple(tmp_path, "a.zip", "2026-05-23", "x", branches=2))]
    seen = []
    for step in (3, 5, 6, 9):
        warehouse = Warehouse(spark, str(tmp_path / f"almacen{step}"))
        shutil.copytree(loaded.root, warehouse.root)
        calls = iter(range(1000))

        def stopping(function, calls=calls, step=step):
            def run(*args, **kwargs):
                if next(calls) == step:
                    raise Stopped
                return function(*args, **kwargs)

            return run

        with monkeypatch.context() as patch:
            patch.setattr(replacement, "AT_ONCE", 1)
            for name in ("remove", "move"):
                patch.setattr(replacement, name, stopping(getattr(replacement, name)))
            for name in ("stage", "stage_file", "commit"):
                patch.setattr(replacement.Replacement, name, stopping(getattr(replacement.Replacement, name)))
            with pytest.raises(Stopped):
                ingest.load_archives(warehouse, entry, reload_existing=True)
        found = rows_of(warehouse)
        assert found in (before, after)
        seen.append(found == after)
        ingest.load_archives(warehouse, entry, reload_existing=not seen[-1])
        assert rows_of(warehouse) == after
        assert warehouse.dates(FACT) == [DAY.replace(day=22), DAY]
        left = tmp_path / f"almacen{step}" / replacement.PENDING
        assert not left.exists() or not any(left.iterdir())
    # Three tables and the ledger are prepared, then agreed by one move; all is new from there on.
    assert seen == [False, False, True, True]


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_members_of_one_name_are_told_apart_by_their_place(warehouse, spark, tmp_path):
    name = "2026-05-23/m.zip"
    path = tmp_path / "a.zip"
    cut = data.simple_member(data.price("roto"))[:200]
    with zipfile.ZipFile(path, "w") as outer:
        for content in (data.simple_member(data.price("a"), data.price("b")), cut, data.simple_member(data.price("c"))):
            outer.writestr(name, content)
    counts = ingest.load_archives(warehouse, [(None, str(path))])
    assert counts == {CHAINS: 2, BRANCHES: 2, FACT: 3}
    assert sorted(r["id_producto"] for r in warehouse.read(FACT).collect()) == ["a", "b", "c"]
    assert states(warehouse) == ["success_with_warnings"]
    frames = inspect_archives(spark, [str(path)], str(tmp_path / "informe"))
    assert [tuple(r)[1:5] for r in frames["archivos"].collect()] == [(3, 2, 0, 1)]
    assert sorted(r.rows_valid for r in frames["reportes"].where("csv = 'productos.csv'").collect()) == [1, 2]


def test_one_failing_archive_leaves_the_others_of_its_batch(warehouse, tmp_path, monkeypatch):
    entries = [(None, simple(tmp_path, f"{n}.zip", f"2026-05-2{n}")) for n in range(3)]
    store = ingest.store

    def failing(where, sources, name):
        if any(s["path"].endswith("1.zip") for s in sources):
            raise Stopped
        return store(where, sources, name)

    monkeypatch.setattr(ingest, "store", failing)
    with pytest.raises(Stopped):
        ingest.load_archives(warehouse, entries)
    assert [d.day for d in warehouse.dates(FACT)] == [20, 22]
    found = {r["zip_filename"]: r["estado"] for r in ingest.control_table(warehouse).collect()}
    assert found == {"0.zip": "success", "1.zip": "failed", "2.zip": "success"}


def test_all_messages_are_kept(warehouse, tmp_path, spark):
    members = {f"2026-05-23/m{i}.zip": b"roto" for i in range(130)}
    ingest.load_archives(warehouse, [(None, data.write_archive(tmp_path / "a.zip", members))])
    record = ingest.control_table(warehouse).first()
    messages = spark.read.parquet(warehouse.path(ingest.ERRORS)).where(f"id_ingesta = '{record['id_ingesta']}'")
    assert record["errores"] == messages.select("mensaje").distinct().count() == 130
    assert len(json.loads(record["detalle"])["errores"]) == ingest.DETAILED_ERRORS


def test_replace_starts_anew_for_the_first_archive_only(warehouse, tmp_path):
    ingest.load_archives(warehouse, [(None, simple(tmp_path, "a.zip", "2026-05-20"))])
    pair = [
        (None, simple(tmp_path, "b.zip", "2026-05-21")),
        (None, simple(tmp_path, "c.zip", "2026-05-22")),
        (None, simple(tmp_path, "d.zip", "2026-05-22", "z")),
    ]
    counts = ingest.load_archives(warehouse, pair, mode="replace")
    assert counts[FACT] == 4 and [d.day for d in warehouse.dates(FACT)] == [21, 22]
    control = {r["zip_filename"]: r for r in ingest.control_table(warehouse).collect()}
    assert {n: (r["modo_carga"], r["estado"]) for n, r in control.items()} == {
        "b.zip": ("replace", "success"),
        "c.zip": ("append", "success"),
        "d.zip": ("append", "skipped"),
    }


def test_forced_date(warehouse, tmp_path):
    archive = simple(tmp_path, "a.zip")
    ingest.load_archives(warehouse, [("2020-02-03", archive), ("2020-02-04", simple(tmp_path, "b.zip"))])
    assert [d.isoformat() for d in warehouse.dates(FACT)] == ["2020-02-03", "2020-02-04"]


def test_a_date_with_dimensions_only_is_not_loaded(warehouse, tmp_path):
    with_chain = data.member(
        data.lines(data.COMERCIO_HEADER, data.chain()), data.lines(data.SUCURSALES_HEADER, data.branch()), None
    )
    ingest.load_archives(warehouse, [(None, data.write_archive(tmp_path / "a.zip", {"2026-05-23/m.zip": with_chain}))])
    ingest.load_archives(warehouse, [(None, simple(tmp_path, "b.zip"))])
    assert rows_of(warehouse) == {CHAINS: 1, BRANCHES: 1, FACT: 2}


def test_unreadable_archive_fails_and_the_others_load(warehouse, tmp_path):
    bad = tmp_path / "mal.zip"
    bad.write_bytes(b"nada")
    entries = [(None, simple(tmp_path, "a.zip")), (None, str(bad)), (None, simple(tmp_path, "c.zip", "2026-05-24"))]
    with pytest.raises(ingest.UnreadableArchive):
        ingest.load_archives(warehouse, entries)
    assert [d.day for d in warehouse.dates(FACT)] == [23, 24]
    control = {r["zip_filename"]: r for r in ingest.control_table(warehouse).collect()}
    assert {n: r["estado"] for n, r in control.items()} == {"a.zip": "success", "mal.zip": "failed", "c.zip": "success"}
    assert json.loads(control["mal.zip"]["detalle"])["errores"][0].startswith("BadZipFile")


def test_batches():
    def archive(path, dates, error=None):
        return ingest.Archive(path, dates=set(dates), error=error)

    a, b, c = archive("a", ["1"]), archive("b", ["2"]), archive("c", ["2", "3"])
    bad, d = archive("x", [], "mal"), archive("d", ["4"])
    assert ingest.batches([a, b, c, bad, d]) == [[a, b], [c], [bad], [d]]
    assert [len(run) for run in ingest.batches([archive(str(i), [str(i)]) for i in range(70)])] == [32, 32, 6]


def test_load_state():
    assert ingest.load_state(0, 1, 5) == "skipped"
    assert ingest.load_state(0, 0, 5) == "success_with_warnings"
    assert ingest.load_state(3, 1, 0) == "success"
    assert ingest.load_state(0, 0, 0) == "success"


def test_exports(warehouse, tmp_path, spark):
    ingest.load_archives(warehouse, [(None, simple(tmp_path, "a.zip"))], export_to=str(tmp_path / "salida"))
    exported = spark.read.option("header", True).csv(str(tmp_path / "salida" / "fact_precios.csv"))
    assert exported.count() == 2 and exported.columns == warehouse.read(FACT).columns


def test_rows_of_archives_of_one_date_are_stored_in_columns_and_written_without_a_shuffle(warehouse, tmp_path, monkeypatch):
    stored, seen = [], []
    store, stage = ingest.store, ingest.Replacement.stage
    monkeypatch.setattr(ingest, "store", lambda *a, **b: stored.append(store(*a, **b)) or stored[-1])
    monkeypatch.setattr(ingest.Replacement, "stage", lambda self, table, *a, **b: seen.append((table, b.get("together"))) or stage(self, table, *a, **b))
    ingest.load_archives(warehouse, [(None, simple(tmp_path, f"{n}.zip", f"2026-05-2{n}", "　 a\x85")) for n in range(2)])
    assert "campos" not in stored[0].columns and "campo_16" in stored[0].columns and "campo_17" not in stored[0].columns
    assert {r["id_producto"] for r in warehouse.read(FACT).collect()} == {"a"}
    two = {f"2026-05-2{n}/m.zip": data.simple_member(data.price(str(n))) for n in (5, 6)}
    ingest.load_archives(warehouse, [(None, data.write_archive(tmp_path / "two.zip", two))])
    assert [together for table, together in seen if table == FACT] == [True, False]
    assert sorted((str(r[DATE]), r["id_producto"]) for r in warehouse.read(FACT).collect()) == [
        ("2026-05-20", "a"), ("2026-05-21", "a"), ("2026-05-25", "5"), ("2026-05-26", "6")
    ]
