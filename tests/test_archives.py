"""Reading, cleaning and inspecting nested archives."""

import datetime

import pytest
from pyspark.sql import functions as F

from gondola.functions.cleaning import clean
from gondola.operators.inspection import file_reports
from gondola.plans.inspect import inspect_archives
from gondola.schemas import BRANCHES, CHAINS, FACT, PRODUCTOS_HEADER, TABLES
from gondola.sources import nested_zip
from gondola.sources.nested_zip import HEADERS, INSPECT, LOAD, MEMBERS, read_archives
from tests import archive_data as data


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    return data.full_archive(tmp_path_factory.mktemp("zip") / "diario.zip")


@pytest.fixture(scope="module")
def prices(spark, archive):
    frame = clean(read_archives(spark, [archive], LOAD, "productos.csv"), TABLES[FACT])
    return {r["id_producto"]: r for r in frame.collect()}


def test_one_partition_per_member(spark, archive):
    assert read_archives(spark, [archive], LOAD).rdd.getNumPartitions() == 11


def test_only_valid_rows_load(prices):
    assert set(prices) == {
        "7790", "q", "r", "a", "d", "n0", "n1", "n2", "n3", "n4", "n5", "n6", "sin sucursal", "sin fecha", "otra",
    }


def test_quoting_and_missing_words(prices):
    assert prices["q"]["productos_descripcion"] == "a|b"
    assert prices["r"]["productos_descripcion"] == "dos\nlineas"
    assert prices["d"]["productos_marca"] is None
    assert prices["d"]["productos_leyenda_promo1"] is None
    assert prices["d"]["productos_leyenda_promo2"] is None


def test_numbers(prices):
    found = [prices[f"n{i}"]["productos_precio_lista"] for i in range(7)]
    assert found == [1234.56, 1234.56, 1.23456, 1.234, None, None, None]


def test_dates(prices, spark, archive):
    assert prices["7790"]["fecha_publicacion"] == datetime.date(2026, 5, 23)
    assert prices["sin fecha"]["fecha_publicacion"] is None
    forced = clean(read_archives(spark, [archive], LOAD, "productos.csv"), TABLES[FACT], "2020-01-02")
    assert {r[0] for r in forced.select("fecha_publicacion").distinct().collect()} == {datetime.date(2020, 1, 2)}


def test_dimensions(spark, archive):
    chains = clean(read_archives(spark, [archive], LOAD, "comercio.csv"), TABLES[CHAINS])
    first = chains.where(F.col("archivo_origen").endswith("cadena_1.zip")).collect()
    assert len(first) == 1 and first[0]["comercio_bandera_nombre"] == "Uno"
    stamp = chains.select(F.col("comercio_ultima_actualizacion").cast("string")).first()[0]
    assert stamp == "2026-05-23 07:00:00"
    branches = clean(read_archives(spark, [archive], LOAD, "sucursales.csv"), TABLES[BRANCHES])
    assert branches.columns[:-2] == list(TABLES[BRANCHES].output)
    assert branches.select("sucursales_latitud").first()[0] == -34.6


def test_states(spark, archive):
    notes = read_archives(spark, [archive], LOAD).where(F.col("tipo") != "fila").collect()
    states = {(r["archivo_origen"].rsplit("/", 1)[-1], r["csv"]): (r["estado"], r["error"]) for r in notes}
    assert states["cadena_5.zip", "productos.csv"][0] == "encabezado"
    assert states["cadena_5.zip", "productos.csv"][1].startswith("ValueError: Encabezado inesperado: ['id_comercio'")
    assert states["cadena_6.zip", "sucursales.csv"][0] == "falta"
    assert states["cadena_7.zip", None][0] == "vacio"
    assert states["cadena_8.zip", None][0] == "corrupto"
    assert states["cadena_11.zip", "productos.csv"][0] == "error"


def test_skipped_dates_are_not_opened(spark, archive):
    source = {"path": archive, "omitir": ["2026-05-23"]}
    names = read_archives(spark, [source], HEADERS).select("archivo_origen").distinct().collect()
    assert [r[0] for r in names] == ["cadena_9.zip"]
    everything = {"path": archive, "fecha": "2026-05-23", "omitir": ["2026-05-23"]}
    assert read_archives(spark, [everything], LOAD).count() == 0


def test_member_names(spark, archive):
    assert read_archives(spark, [archive], MEMBERS).count() == 11


@pytest.mark.parametrize("before", [0, 1, 1499, 1500, 1501, 9000])
def test_no_row_of_a_member_with_a_broken_file_is_loaded(spark, tmp_path, monkeypatch, before):
    """Wherever the break is; an inspection reports the rows that were read."""
    monkeypatch.setattr(nested_zip, "BATCH_ROWS", 1500)
    content = data.lines(PRODUCTOS_HEADER, *[data.price(str(i)) for i in range(before)]) + b"\xff\r\n"
    members = {"2026-01-01/a.zip": data.member(prices=content), "2026-01-01/b.zip": data.simple_member(data.price("b"))}
    path = data.write_archive(tmp_path / "roto.zip", members)
    raw = read_archives(spark, [path], LOAD)
    loaded = nested_zip.whole_members(raw).select("archivo_origen", "csv").distinct().collect()
    assert {r.archivo_origen for r in loaded} == {"2026-01-01/b.zip"} and len(loaded) == 3
    notes = raw.where("tipo = 'csv' and estado = 'error'").collect()
    assert [r.archivo_origen for r in notes] == ["2026-01-01/a.zip"]
    part = nested_zip.MemberPartition(path, "2026-01-01/a.zip", 0)
    batches = nested_zip.NestedZipReader({"path": path, "lectura": INSPECT, "csv": "productos.csv"}).read(part)
    kinds = [row for batch in batches for row in batch.to_pylist()]
    seen = [r["campos"][3] for r in kinds if r["tipo"] == "fila"]
    assert seen == [str(i) for i in range(len(seen))] and len(seen) <= before


def test_batches_leave_as_they_are_read(tmp_path, monkeypatch):
    monkeypatch.setattr(nested_zip, "BATCH_ROWS", 100)
    content = data.lines(PRODUCTOS_HEADER, *[data.price(str(i)) for i in range(1000)])
    path = data.write_archive(tmp_path / "a.zip", {"2026-01-01/a.zip": data.member(prices=content)})
    part = nested_zip.MemberPartition(path, "2026-01-01/a.zip", 0)
    sizes = [batch.num_rows for batch in nested_zip.NestedZipReader({"path": path, "csv": "productos.csv"}).read(part)]
    assert max(sizes) == 100 and sum(sizes) == 1002


def test_large_members_are_spooled(archive, monkeypatch):
    def read_all():
        reader = nested_zip.NestedZipReader({"path": archive})
        return [row for part in reader.partitions() for batch in reader.read(part) for row in batch.to_pylist()]

    held = read_all()
    monkeypatch.setattr(nested_zip, "SPOOL_BYTES", 1)
    assert read_all() == held


def test_inspection(spark, archive, tmp_path):
    result = inspect_archives(spark, [archive], str(tmp_path / "salida"))
    counts = result["archivos"].first()
    assert [counts[c] for c in ("inner_zips_total", "inner_zips_valid", "inner_zips_empty", "inner_zips_corrupt")] == [
        11, 9, 1, 1,
    ]
    reports = {(r["archivo_origen"].rsplit("/", 1)[-1], r["csv"]): r for r in result["reportes"].collect()}
    assert reports["cadena_1.zip", "comercio.csv"]["footer_rows_removed"] == 1
    assert reports["cadena_1.zip", "comercio.csv"]["rows_total"] == 1
    awkward = reports["cadena_3.zip", "productos.csv"]
    assert (awkward["rows_total"], awkward["rows_valid"], awkward["rows_invalid"]) == (5, 3, 2)
    assert not reports["cadena_5.zip", "productos.csv"]["header_ok"]
    assert reports["cadena_5.zip", "productos.csv"]["rows_valid"] == 1
    assert not reports["cadena_6.zip", "sucursales.csv"]["present"]
    assert reports["cadena_11.zip", "productos.csv"]["error"] == "No se pudo decodificar como UTF-8."
    totals = {r["csv"]: r for r in result["totales"].collect()}
    assert totals["sucursales.csv"]["files_present"] == 8
    # One header is renamed, one is lost with its undecodable file.
    assert totals["productos.csv"]["files_with_valid_header"] == 7
    errors = {(r["archivo_origen"], r["error"]) for r in result["errores"].collect()}
    assert ("2026-05-23/cadena_7.zip", "ZIP interno vacío.") in errors
    assert ("2026-05-23/cadena_8.zip", "ZIP interno corrupto.") in errors
    assert len(errors) == 3
    assert spark.read.json(str(tmp_path / "salida" / "totales")).count() == 3


def many_members(path, n: int) -> str:
    return data.write_archive(path, {f"2026-01-01/m{i:04}.zip": data.simple_member(data.price(str(i))) for i in range(n)})


def test_many_small_members_share_tasks(spark, tmp_path):
    raw = read_archives(spark, [many_members(tmp_path / "a.zip", 300)], LOAD)
    # Four tasks a core, and one more where a sum does not come out even; 300 before.
    assert raw.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism + 1
    notes = raw.where("tipo = 'miembro'").select("orden", "archivo_origen", "estado").collect()
    assert sorted(notes) == [(i, f"2026-01-01/m{i:04}.zip", "ok") for i in range(300)]
    fields = raw.where("csv = 'productos.csv' and tipo = 'fila'").select("orden", F.col("campos")[3]).collect()
    assert sorted(map(tuple, fields)) == [(i, str(i)) for i in range(300)]
    assert read_archives(spark, [str(tmp_path / "a.zip")], MEMBERS).count() == 300


def test_tasks_follow_the_bytes_and_directories_are_read_a_bounded_number_of_times():
    mb = 1 << 20
    assert nested_zip.bundles([[mb] * 3, [], [mb]], 16) == [[0, 1, 2], [], [0]]
    # Ten times the members of a size: ten times the tasks. A large member is alone.
    assert [max(nested_zip.bundles([[mb] * n], 16)[0]) + 1 for n in (1500, 15_000)] == [100, 1000]
    assert nested_zip.bundles([[mb] * 8 + [40 * mb] + [mb] * 8], 2) == [[0] * 8 + [1] + [2] * 8]
    # Very many members in one archive: its directory, which names them all, is not read more often for it.
    for n in (10_000, 1_000_000):
        assert max(nested_zip.bundles([[100] * n], 16)[0]) < 1100


def test_a_task_opens_its_archive_once(tmp_path, monkeypatch):
    path, opened = many_members(tmp_path / "a.zip", 200), []
    plain = nested_zip.members_of
    monkeypatch.setattr(nested_zip, "members_of", lambda outer: opened.append(1) or plain(outer))
    reader = nested_zip.NestedZipReader({"path": path})
    parts = reader.partitions()
    assert sum(batch.num_rows for part in parts for batch in reader.read(part)) >= 200
    assert len(opened) == 1 + len(parts) < 20


def test_short_batches_leave_a_task_as_one(archive):
    reader = nested_zip.NestedZipReader({"path": archive, "lectura": LOAD, "tareas": "1"})
    (part,) = reader.partitions()
    batches = list(reader.read(part))
    assert len(part.members) == 11 and len(batches) == 1
    assert batches[0].column("tipo").to_pylist().count("miembro") == 11


def test_merged_batches_are_bounded(monkeypatch):
    part = nested_zip.MemberPartition("z", "m", 0)
    notes = [nested_zip.note(part, "miembro", "ok")] * 25
    monkeypatch.setattr(nested_zip, "BATCH_ROWS", 10)
    assert [b.num_rows for b in nested_zip.merged(iter(notes))] == [10, 10, 5]
    monkeypatch.setattr(nested_zip, "MERGED_BYTES", notes[0].nbytes * 4)
    assert [b.num_rows for b in nested_zip.merged(iter(notes))] == [4] * 6 + [1]
    assert list(nested_zip.merged(iter([]))) == []


def test_a_header_alone_reads_no_more(tmp_path, monkeypatch):
    many = data.lines(PRODUCTOS_HEADER, *[data.price(f"p{i}") for i in range(5000)])
    path = data.write_archive(tmp_path / "largo.zip", {"2026-05-23/a.zip": data.member(None, None, many)})
    read, texts = [], nested_zip.Records._texts
    monkeypatch.setattr(nested_zip.Records, "_texts", lambda self, *a: (read.append(len(t)) or t for t in texts(self, *a)))
    reader = nested_zip.NestedZipReader({"path": path, "lectura": HEADERS})
    (part,) = reader.partitions()
    states = [(r["csv"], r["estado"]) for b in reader.read(part) for r in b.to_pylist()]
    assert states == [("comercio.csv", "falta"), ("sucursales.csv", "falta"), ("productos.csv", "ok"), (None, "ok")]
    assert sum(read) <= nested_zip.READ_BYTES


def test_reports_hash_the_rows(spark, archive):
    plan = file_reports(read_archives(spark, [archive], INSPECT))._jdf.queryExecution().executedPlan().toString()
    lowest = [line for line in plan.split("BatchScan")[0].splitlines() if "Aggregate" in line or " Sort " in line][-1]
    assert "HashAggregate" in lowest and "problema" in lowest


def test_rows_of_a_stored_scan_are_not_moved_for_broken_members(spark, archive, tmp_path):
    raw = read_archives(spark, [archive], LOAD)
    raw.write.parquet(str(tmp_path / "filas"))
    stored = spark.read.schema(raw.schema).parquet(str(tmp_path / "filas"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = nested_zip.whole_members(stored, stored.where("tipo <> 'fila'"))
        assert "BroadcastHashJoin" in whole._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, whole.collect())) == sorted(map(str, nested_zip.whole_members(stored).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
