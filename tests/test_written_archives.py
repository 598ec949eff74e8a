"""The archives that the checks write: how they grow, and their damage."""

import io
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import archives
from gondola.operators import inspection
from gondola.sources.nested_zip import HEADERS, INSPECT, LOAD, Records, read_archives


def prices(spark, rows: int, banners: int = 6):
    number = F.col("id")
    return spark.range(rows).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (number % 2).cast("int")).alias("fecha_publicacion"),
        F.lit("1").alias("id_comercio"),
        (number % banners).cast("string").alias("id_bandera"),
        (number % 5).cast("string").alias("id_sucursal"),
        number.cast("string").alias("id_producto"),
        (number + 0.5).alias("productos_precio_lista"),
    )


def batch(begin: int, n: int) -> pa.RecordBatch:
    ids = [str(i) for i in range(begin, begin + n)]
    columns = {"id_comercio": ["1"] * n, "id_bandera": ["4"] * n, "id_sucursal": ["2"] * n, "id_producto": ids}
    return pa.RecordBatch.from_pydict(columns, pa.schema([(name, pa.string()) for name in columns]))


def test_archives_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(archives, "ARCHIVE_ROWS", 100)
    paths = archives.archives(spark, "test-grow", prices(spark, 2000))
    assert len(paths) == 20
    rows = read_archives(spark, paths, LOAD, "productos.csv").where("tipo = 'fila'")
    assert sorted(int(r[0]) for r in rows.select(F.col("campos")[3]).collect()) == list(range(2000))


def test_fields_with_marks_come_back(spark):
    texts = ['a|b', 'say "hi"', '"', "two\r\nlines", "", None, " x "]
    rows = pa.RecordBatch.from_pydict({"id_producto": pa.array(texts, pa.string()), "productos_precio_lista": [1.5, None, 0.1, 1e20, 5.0, -2.0, 3.0]})
    made = archives._joined(archives._lines(rows, ["id_producto", "sin", "productos_precio_lista"]))
    found = [r for part in Records(io.BytesIO(made)) for r in part.to_pylist()]
    assert [r[0] for r in found] == [t or "" for t in texts]
    assert [r[1] for r in found] == [""] * 7
    assert [float(r[2]) if r[2] else None for r in found] == rows["productos_precio_lista"].to_pylist()


@pytest.mark.parametrize("sizes", [[10], [3, 3, 4], [5, 5], [1], [0, 7]])
def test_a_cut_member_is_streamed_and_holds_half_of_its_rows_before_the_break(sizes):
    out, held = io.BytesIO(), []

    def batches():
        begin = 0
        for n in sizes:
            made = batch(begin, n)
            held.append(n)
            yield made
            begin += n

    archives._damaged_member(batches(), archives.CUT, sum(sizes), out)
    with zipfile.ZipFile(out) as inner:
        content = inner.read("productos.csv")
        before, _, after = content.partition(archives._BREAK)
        assert before.count(b"\r\n") == 1 + sum(sizes) // 2 and after.count(b"\r\n") == sum(sizes) - sum(sizes) // 2
        assert inner.read("sucursales.csv").count(b"\r\n") == 2
    assert held == sizes


def test_damaged_archives_a_task_a_member_and_an_archive_a_date(spark):
    tasks = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rotos", "rotos")
    paths = archives.broken_archives(spark, prices(spark, 1200))
    stages = [tasks.getStageInfo(s) for j in tasks.getJobIdsForGroup("rotos") for s in tasks.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(paths) == 2
    # Banners 0, 2 and 4 are of the first date, 1, 3 and 5 of the second; a task of a date had them all before.
    assert 6 in [s.numTasks for s in stages if s]
    counts = inspection.member_counts(read_archives(spark, paths, HEADERS)).drop("zip").collect()
    assert sorted(map(tuple, counts)) == [(3, 2, 0, 1), (3, 2, 1, 0)]
    reports = inspection.file_reports(read_archives(spark, paths, INSPECT)).where("csv = 'productos.csv'")
    found = {r["archivo_origen"][-5]: (r["rows_valid"], r["rows_invalid"], r["header_ok"]) for r in reports.collect()}
    assert found == {"2": (200, 0, False), "3": (200, 0, True), "4": (100, 0, True), "5": (200, 2, True)}


def test_joins_of_the_prices_begin_with_partitions_by_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows, partitions in ((950 * archives.JOIN_ROWS, 950), (10, 4)):
            with archives.joins_by_rows(spark, rows):
                joined = spark.range(10).join(spark.range(10), "id")
                plan = joined._jdf.queryExecution().executedPlan().toString()
            assert f", {partitions})" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.conf.get(archives._PARTITIONS, None) is None


def test_written_archives_join_by_rows(spark, monkeypatch):
    asked, made = [], archives.joins_by_rows
    monkeypatch.setattr(archives, "joins_by_rows", lambda session, rows: asked.append(rows) or made(session, rows))
    archives.archives(spark, "test-joins", prices(spark, 600))
    archives.broken_archives(spark, prices(spark, 1200))
    assert asked == [600, 1200]


@pytest.mark.parametrize("lines", [pa.array([], pa.string()), pa.array(["x", "a", "", "ñ|b"]).slice(1), pa.chunked_array([["a"], ["", "ñ|b"]])])
def test_lines_joined(lines):
    assert archives._joined(lines) == "".join(f"{line}\r\n" for line in lines.to_pylist()).encode()
