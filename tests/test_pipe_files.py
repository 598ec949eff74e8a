"""Files that many tasks read: the same records as one reader gives, wherever they are cut."""

import csv
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from gondola.plans import ingest
from gondola.schemas import PRODUCTOS_HEADER, TABLES
from gondola.sources import pipe_files
from gondola.sources.nested_zip import LOAD, read_archives, whole_members
from gondola.sources.tables import Warehouse
from tests import archive_data as data

DAY = "2026-05-23"


class Stream:
    def __init__(self, content):
        self.content = content

    def read_at(self, size, at):
        return self.content[at : at + size]


def composed(content, part):
    """Records by parts and their two-state maps, composed one after another."""
    size, inside, begins = len(content), False, []
    for number in range(max(1, -(-size // part))):
        begin = pipe_files.line_start(Stream(content), number * part, size)
        end = pipe_files.line_start(Stream(content), (number + 1) * part, size)
        left, stays, closes = pipe_files.edges(content[begin:end])
        begins.append((None if closes is None else begin + closes) if inside else begin)
        inside = stays if inside else left
    known = [b for b in begins if b is not None] + [size]
    pieces = [content[a:b].decode() for a, b in zip(known, known[1:])]
    return [row for text in pieces for row in csv.reader(io.StringIO(text, newline=""), delimiter="|")]


@pytest.mark.parametrize("seed", range(300))
def test_records_do_not_depend_on_the_cuts(seed, monkeypatch):
    chance = random.Random(seed)
    monkeypatch.setattr(pipe_files, "WINDOW_BYTES", chance.choice([1, 2, 3, 64]) + 1)
    content = "".join(chance.choices(["a", "é", '"', '""', "|", "\n", "\r\n", "\r", '|"', '"|'], k=chance.randint(0, 80))).encode()
    whole = list(csv.reader(io.StringIO(content.decode(), newline=""), delimiter="|"))
    assert composed(content, chance.randint(1, 30)) == whole


def unpacked(archive, folder):
    with zipfile.ZipFile(archive) as outer:
        for entry in outer.infolist():
            if entry.filename.lower().endswith(".zip"):
                target = folder / entry.filename
                target.mkdir(parents=True)
                try:
                    zipfile.ZipFile(io.BytesIO(outer.read(entry))).extractall(target)
                except zipfile.BadZipFile:
                    pass
    return str(folder)


def rows(scan):
    found = whole_members(scan).select("archivo_origen", "csv", "campos").collect()
    return sorted((r["archivo_origen"], r["csv"], tuple(r["campos"])) for r in found)


def quoted_archive(path, count=400):
    texts = ['"dos\nlineas"', '"tres\r\n""lineas""\r\n|fin"', 'pulgadas 5"', "llano", '"' + "largo\n" * 60 + '"', '"\n"']
    prices = [data.price(f"{i}", f"{i}.5", productos_descripcion=texts[i * 7 % len(texts)]) for i in range(count)]
    return data.write_archive(path, {f"{DAY}/grande.zip": data.simple_member(*prices), f"{DAY}/chico.zip": data.simple_member(data.price())})


@pytest.mark.parametrize("part", [4000, 1 << 25])
def test_same_rows_as_the_archive(spark, tmp_path, part):
    for name, archive in (("q", quoted_archive(tmp_path / "q.zip")), ("f", data.full_archive(tmp_path / "f.zip"))):
        expected = rows(read_archives(spark, [archive], LOAD))
        split = pipe_files.read_sources(spark, [{"path": archive}], str(tmp_path / f"des-{name}"), True, part)
        assert rows(split) == expected
        folder = unpacked(archive, tmp_path / f"carpeta-{name}")
        assert rows(pipe_files.read_sources(spark, [{"path": folder}], part_bytes=part)) == expected


def test_one_member_is_read_by_many_tasks(spark, tmp_path):
    archive = quoted_archive(tmp_path / "q.zip")
    files, _ = pipe_files.unpack(spark, [{"path": archive, "lugar": 0}], str(tmp_path / "des"))
    ranges = pipe_files.record_ranges(files, 2000).where("csv = 'productos.csv'").collect()
    assert len([r for r in ranges if "grande" in r["archivo_origen"]]) > 10
    assert pipe_files.read_files(files, 2000).rdd.getNumPartitions() > 10


@pytest.mark.parametrize("how", ["split", "folder"])
def test_loads_agree(spark, tmp_path, how):
    archive = data.full_archive(tmp_path / "diario.zip")
    path = unpacked(archive, tmp_path / "diario") if how == "folder" else archive
    warehouse = Warehouse(spark, str(tmp_path / how))
    counts = ingest.load_archives(warehouse, [(None, path)], split_members=how == "split")
    plain = Warehouse(spark, str(tmp_path / "llano"))
    assert counts == ingest.load_archives(plain, [(None, archive)])
    for table in TABLES:
        columns = [c for c in plain.read(table).columns]
        assert sorted(map(str, warehouse.read(table).select(columns).collect())) == sorted(map(str, plain.read(table).collect()))
    if how != "folder":  # what is no archive has no files, so a folder does not show it
        messages = [w.spark.read.parquet(w.path(ingest.ERRORS)).select("orden", "csv", "mensaje").collect() for w in (warehouse, plain)]
        assert sorted(map(str, messages[0])) == sorted(map(str, messages[1]))
    # Loaded dates are skipped, however the archive comes.
    assert not sum(ingest.load_archives(warehouse, [(DAY, path)]).values())


def test_files_in_the_folder_itself_and_nothing_at_all(spark, tmp_path):
    folder = tmp_path / DAY
    folder.mkdir()
    (folder / "PRODUCTOS.CSV").write_bytes(data.lines(PRODUCTOS_HEADER, data.price("a"), bom=True))
    (folder / "otro.txt").write_text("nada")
    (folder / "sucursales.csv").write_bytes(b"")
    scan = pipe_files.read_sources(spark, [{"path": str(folder)}])
    assert [r[:2] for r in rows(scan)] == [(DAY, "productos.csv")]
    notes = {(r["csv"], r["estado"]) for r in scan.where("tipo <> 'fila'").collect()}
    assert notes == {(None, "ok"), ("comercio.csv", "falta"), ("sucursales.csv", "vacio"), ("productos.csv", "ok")}
    (tmp_path / "vacia").mkdir()
    assert not pipe_files.read_sources(spark, [{"path": str(tmp_path / "vacia")}]).count()
    assert not pipe_files.read_sources(spark, []).count()


def test_a_break_in_any_part_breaks_the_member(spark, tmp_path):
    for name, at in (("principio", 1), ("fin", 300)):
        prices = [data.price(f"{i}") for i in range(300)]
        content = data.lines(PRODUCTOS_HEADER, *prices[:at]) + b"1|\xff\r\n" + b"\r\n".join(p.encode() for p in prices[at:])
        member = tmp_path / name / f"{DAY}-m"
        member.mkdir(parents=True)
        (member / "productos.csv").write_bytes(content)
        scan = pipe_files.read_sources(spark, [{"path": str(tmp_path / name)}], part_bytes=1000)
        assert rows(scan) == []
        assert [r["estado"] for r in scan.where("tipo = 'csv' and error is not null").collect()] == ["error"]


def test_small_members_and_parts_share_tasks(spark, tmp_path):
    members = {f"{DAY}/m{i:03}.zip": data.simple_member(data.price(str(i))) for i in range(150)}
    path = data.write_archive(tmp_path / "a.zip", members)
    files, notes = pipe_files.unpack(spark, [{"path": path, "lugar": 0}], str(tmp_path / "des"))
    most = 4 * spark.sparkContext.defaultParallelism
    assert len(list((tmp_path / "des" / "listado").glob("*.parquet"))) <= most + 1
    assert files.count() == 450 and notes.where("estado = 'ok'").count() == 150
    scan = pipe_files.read_files(files, 10)
    assert scan.rdd.getNumPartitions() <= most
    assert sorted(r[0] for r in scan.where("csv = 'productos.csv' and tipo = 'fila'").select(F.col("campos")[3]).collect()) == sorted(map(str, range(150)))
