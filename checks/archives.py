"""Nested archives written by Spark tasks from the price view, for the archive and load checks.

Every partition of the price view, of about ``ARCHIVE_ROWS`` rows, becomes one outer archive; every Arrow batch of it adds one inner
ZIP per date. Nothing is gathered: archives and members grow in number with the data. A damaged member holds all rows of a date and banner:
a task streams it into a file, and a task of the date puts its members together.
"""

from __future__ import annotations

import io
import shutil
import sys
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.folders import run_folder
from gondola.schemas import COMERCIO_HEADER, PRODUCTOS_HEADER, SUCURSALES_HEADER
from gondola.sources.replacement import delete_folder

_HEADERS = {
    "comercio.csv": list(COMERCIO_HEADER),
    "sucursales.csv": list(SUCURSALES_HEADER),
    "productos.csv": list(PRODUCTOS_HEADER),
}
_KEYS = {name: [c for c in ("id_comercio", "id_bandera", "id_sucursal") if c in header] for name, header in _HEADERS.items()}
#: Rows of an archive; below, there are as many archives as cores.
ARCHIVE_ROWS = 1_000_000
#: Rows of the prices for each partition with which their joins begin; few enough partitions that their writers hold no rows.
JOIN_ROWS = 1_200_000
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_WRITTEN: dict[tuple[str, str], list[str]] = {}


def _heading(header: list[str]) -> bytes:
    return ("|".join(header) + "\r\n").encode("utf-8-sig")


def _lines(rows: pa.RecordBatch | pa.Table, header: list[str]) -> pa.Array:
    """A line a row without its end; fields with a mark or a line end are quoted, those without a column are empty."""
    fields = []
    for name in header:
        if name not in rows.schema.names:
            fields.append(pa.scalar(""))
            continue
        text = pc.cast(rows[name], pa.string())
        if pa.types.is_string(rows[name].type):
            marked = pc.match_substring_regex(text, r'[|"\r\n]')
            if pc.any(marked).as_py():
                quoted = pc.binary_join_element_wise('"', pc.replace_substring(text, '"', '""'), '"', "")
                text = pc.if_else(marked, quoted, text)
        fields.append(text)
    return pc.binary_join_element_wise(*fields, "|", null_handling="replace", null_replacement="")


def _joined(lines: pa.Array | pa.ChunkedArray) -> bytes:
    # Lines with their ends follow each other in the array's bytes.
    end, nothing = (pa.scalar(text, pa.large_string()) for text in ("\r\n", ""))
    ended = pc.binary_join_element_wise(pc.cast(lines, pa.large_string()), end, nothing)
    ended = ended.combine_chunks() if isinstance(ended, pa.ChunkedArray) else ended
    if not len(ended):
        return b""
    offsets = memoryview(ended.buffers()[1]).cast("q")
    return ended.buffers()[2][offsets[ended.offset] : offsets[ended.offset + len(ended)]].to_pybytes()


def _distinct(rows: pa.RecordBatch | pa.Table, keys: list[str]) -> pa.Table:
    table = pa.Table.from_batches([rows]) if isinstance(rows, pa.RecordBatch) else rows
    return table.select(keys).group_by(keys).aggregate([])


def _member(rows: pa.RecordBatch, prices: pa.Array) -> bytes:
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as inner:
        for name, header in _HEADERS.items():
            if name == "productos.csv":
                inner.writestr(name, _heading(header) + _joined(prices))
            else:
                inner.writestr(name, _heading(header) + _joined(_lines(_distinct(rows, _KEYS[name]), header)) + _FOOTER)
    return packed.getvalue()


def _write_partitions(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(root, recursive=True)
        path = f"{root}/precios_{number}.zip"
        # A repeated task writes under a name of its own and replaces the finished file in one step.
        draft = f"{path}.{TaskContext.get().taskAttemptId()}"
        members = 0
        with system.open_output_stream(draft) as out, zipfile.ZipFile(out, "w") as outer:
            for batch in batches:
                lines, days = _lines(batch, _HEADERS["productos.csv"]), batch["fecha_publicacion"]
                for day in sorted(pc.unique(days.drop_null()).to_pylist()):
                    here = pc.equal(days, day)
                    outer.writestr(f"{day}/cadena_{number}_{members}.zip", _member(batch.filter(here), lines.filter(here)))
                    members += 1
        if members:
            system.move(draft, path)
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/precios_{number}.zip"], "miembros": pa.array([members], pa.int32())})

    return write


#: What is wrong with the member of a banner, by the banner's number modulo six.
EMPTY, CORRUPT, OTHER_HEADER, NO_BRANCHES, CUT, SHORT_ROWS = range(6)
_FOOTER, _SHORT = b"Ultima actualizacion: hoy\r\n", b"9|1\r\n"


#: More blank lines than a reader takes at once, so that all rows before them are read, and a byte that is no text.
_BREAK = b"\r\n" * 10_000 + b"1|\xff"


def _damaged_member(batches: Iterator[pa.RecordBatch], kind: int, count: int, out) -> None:
    """Stream the member of a banner and date, of ``count`` rows, with its damage; the checks' SQL says what is left of its rows."""
    if kind == EMPTY:
        return
    if kind == CORRUPT:
        out.write(b"esto no es un zip")
        return
    kept = {name: [] for name, keys in _KEYS.items() if name != "productos.csv"}
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as inner:
        with inner.open("productos.csv", "w", force_zip64=True) as prices:
            heading = _heading(_HEADERS["productos.csv"])
            prices.write(heading.replace(b"id_comercio", b"otro", 1) if kind == OTHER_HEADER else heading)
            # Half of the rows, then the break in the middle of many rows.
            left = count // 2 if kind == CUT else None
            for batch in batches:
                lines = _lines(batch, _HEADERS["productos.csv"])
                if left is not None and left <= len(lines):
                    prices.write(_joined(lines[:left]) + _BREAK)
                    lines, left = lines[left:], None
                elif left is not None:
                    left -= len(lines)
                prices.write(_joined(lines))
                for name, found in kept.items():
                    found[:] = [_distinct(pa.concat_tables([*found, _distinct(batch, _KEYS[name])]), _KEYS[name])]
            if kind == SHORT_ROWS:
                prices.write(_SHORT + _SHORT + _FOOTER)
        for name, found in kept.items():
            if not (kind == NO_BRANCHES and name == "sucursales.csv"):
                content = _heading(_HEADERS[name]) + _joined(_lines(found[0], _HEADERS[name]))
                inner.writestr(name, content + _FOOTER if kind == SHORT_ROWS and name == "comercio.csv" else content)


def _write_damaged(folder: str):
    """All rows of a date and banner to a member of its own; a batch is held at a time."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import chain

        from pyspark import TaskContext

        rows = (batch for batch in batches if batch.num_rows)
        first = next(rows, None)
        if first is None:
            return
        day, banner, count = (first[name][0].as_py() for name in ("fecha_publicacion", "id_bandera", "filas"))
        system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(f"{root}/{day}", recursive=True)
        path = f"{root}/{day}/bandera_{banner}.zip"
        draft = f"{path}.{TaskContext.get().taskAttemptId()}"
        with system.open_output_stream(draft) as out:
            _damaged_member(chain([first], rows), int(banner) % 6, count, out)
        system.move(draft, path)
        yield pa.RecordBatch.from_pydict({"fecha_publicacion": [day], "id_bandera": [banner]})

    return write


def _put_together(folder: str, pieces: str):
    """The members of a date, copied as they are, to one archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        source = fs.FileSystem.from_uri(pieces)[1] if "://" in pieces else pieces
        for row in (row for batch in batches for row in batch.to_pylist()):
            day = row["fecha_publicacion"]
            draft = f"{root}/rotos_{day}.zip.{TaskContext.get().taskAttemptId()}"
            with system.open_output_stream(draft) as out, zipfile.ZipFile(out, "w") as outer:
                for banner in row["banderas"]:
                    name = f"{day}/bandera_{banner}.zip"
                    with system.open_input_file(f"{source}/{name}") as packed, outer.open(name, "w", force_zip64=True) as member:
                        shutil.copyfileobj(packed, member, 1 << 20)
            system.move(draft, f"{root}/rotos_{day}.zip")
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/rotos_{day}.zip"]})

    return write


cloudpickle.register_pickle_by_value(sys.modules[__name__])


@contextmanager
def joins_by_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Joins within it begin with a partition for ``JOIN_ROWS`` rows, or the session's number if that is more; Spark merges small ones.

    So what a task sorts is bounded by the size up to which they are merged, however large the tables are.
    """
    before = spark.conf.get(_PARTITIONS, None)
    spark.conf.set(_PARTITIONS, max(int(before or spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // JOIN_ROWS)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PARTITIONS)
        else:
            spark.conf.set(_PARTITIONS, before)


def broken_archives(spark: SparkSession, prices: DataFrame) -> list[str]:
    """Paths of one archive a date with all its prices, in a member for each banner; most members are damaged."""
    folder = run_folder(spark, "rotos").removeprefix("file:")
    rows = prices.where("fecha_publicacion is not null").withColumn("fecha_publicacion", F.col("fecha_publicacion").cast("string"))
    keys = ["fecha_publicacion", "id_bandera"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("filas")).collect()
    if not counts:
        return []
    # A task a member.
    place = spark.createDataFrame([(*row, i) for i, row in enumerate(sorted(counts))], "fecha_publicacion string, id_bandera string, filas long, lugar int")
    dealt = rows.join(F.broadcast(place), keys).repartitionById(len(counts), "lugar").drop("lugar")
    pieces = f"{folder}/miembros"
    with joins_by_rows(spark, sum(row["filas"] for row in counts)):
        written = dealt.mapInArrow(_write_damaged(pieces), "fecha_publicacion string, id_bandera string").collect()
    days: dict[str, list[str]] = {}
    for row in sorted(written):
        days.setdefault(row["fecha_publicacion"], []).append(row["id_bandera"])
    listed = spark.createDataFrame([(i, *day) for i, day in enumerate(days.items())], "lugar int, fecha_publicacion string, banderas array<string>")
    whole = listed.repartitionById(len(days), "lugar").mapInArrow(_put_together(folder, pieces), "path string")
    paths = sorted(r["path"] for r in whole.collect())
    delete_folder(pieces)
    return paths


def archives(spark: SparkSession, sf_dir: str, prices: DataFrame) -> list[str]:
    """Paths of the archives derived from the prices of a data folder, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        folder = run_folder(spark, "archivos").removeprefix("file:")
        rows = prices.withColumn("fecha_publicacion", F.col("fecha_publicacion").cast("string"))
        count = prices.count()
        number = max(spark.sparkContext.defaultParallelism, -(-count // ARCHIVE_ROWS))
        written: DataFrame = rows.repartition(number).mapInArrow(_write_partitions(folder), "path string, miembros int")
        with joins_by_rows(spark, count):
            _WRITTEN[key] = sorted(r["path"] for r in written.collect())
    return _WRITTEN[key]
