"""Batch source for nested archives: outer ZIP -> inner ZIPs -> pipe-separated files.

    spark.read.format("precios_zip").option("path", "/shared/2026-05-23.zip").load()

Neighbouring inner ZIPs (members) make an input partition of up to ``TASK_BYTES``, a single one where there are
few; so the number of tasks follows the bytes, and an archive's directory is read ``ARCHIVE_TASKS`` times at
most, however many members it lists. The driver only reads central directories. A task unpacks its members one
after the other, once, in memory up to ``SPOOL_BYTES`` and on the task's own disk beyond; the files in them are
streamed and leave as Arrow batches as they are read. Rows
come out raw, as lists of fields: which of them are valid is decided by Spark expressions
(``gondola.functions.cleaning``).

A file that breaks in the middle has its rows before the break in the output and a note that says so. A
load takes no row of a member with such a note (``whole_members``), at whichever row the break is.

Paths may carry any scheme pyarrow knows (local, ``hdfs://``, ``s3://``, ``gs://``).
"""

from __future__ import annotations

import csv
import io
import json
import re
import shutil
import sys
import tempfile
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gondola.functions.cleaning import WHITESPACE
from gondola.schemas import TABLES

FORMAT = "precios_zip"
#: (file name, header) in reading order, as plain data so that it travels to the workers by value.
FILES = [(spec.csv, list(spec.header)) for spec in TABLES.values()]

SCHEMA = (
    "zip string, archivo_origen string, orden int, csv string, "
    "tipo string, estado string, campos array<string>, error string, archivo int"
)
ARROW_SCHEMA = pa.schema(
    [
        ("zip", pa.string()),
        ("archivo_origen", pa.string()),
        ("orden", pa.int32()),
        ("csv", pa.string()),
        ("tipo", pa.string()),  # miembro | csv | fila
        ("estado", pa.string()),  # ok | vacio | corrupto | falta | encabezado | error
        ("campos", pa.list_(pa.string())),
        ("error", pa.string()),
        ("archivo", pa.int32()),  # place of the outer archive in the list of the scan
    ]
)

#: Fixed value: message of an unknown header.
UNKNOWN_HEADER = "ValueError: Encabezado inesperado: "
BATCH_ROWS = 10_000
#: Bytes of lines that are split together, and of one read.
BLOCK_BYTES, READ_BYTES = 1 << 20, 1 << 13
#: Bytes up to which short batches leave a task as one, of ``BATCH_ROWS`` rows at most.
MERGED_BYTES = 4 << 20
SPOOL_BYTES = 64 * 1024 * 1024
#: Packed bytes of a task, what opening a member counts for, and the most tasks that read one archive's directory.
TASK_BYTES, MEMBER_BYTES, ARCHIVE_TASKS = 16 * 1024 * 1024, 1 << 16, 1000
#: Tasks below which members do not share one, where the session does not say.
LEAST_TASKS = 16

#: Reading modes.
MEMBERS = "miembros"  # names only, no member is opened
HEADERS = "encabezados"  # state of every member and of its files' headers
LOAD = "carga"  # rows as a load takes them: a fatal problem ends the member
INSPECT = "inspeccion"  # rows as an inspection counts them: problems never end the member


@dataclass
class MemberPartition(InputPartition):
    """One inner ZIP, or the whole outer one when only names are listed."""

    zip: str
    member: str | None
    order: int
    archive: int = 0


@dataclass
class BundlePartition(InputPartition):
    """Members of one archive that a task reads one after the other."""

    members: list[MemberPartition]


def date_in_name(name: str) -> str | None:
    """The first ``yyyy-mm-dd`` in a member name, if it is a real date."""
    found = re.search(r"\d{4}-\d{2}-\d{2}", name)
    try:
        return date.fromisoformat(found.group()).isoformat() if found else None
    except ValueError:
        return None


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


@contextmanager
def open_archive(path: str) -> Iterator[zipfile.ZipFile]:
    system, inner = file_system(path)
    with system.open_input_file(inner) as stream:
        try:
            outer = zipfile.ZipFile(stream)
        except pa.ArrowInvalid as problem:  # too short to be searched for a directory
            raise zipfile.BadZipFile("File is not a zip file") from problem
        with outer:
            yield outer


def members_of(outer: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """The inner ZIPs in the order of the directory; several may have one name."""
    return [entry for entry in outer.infolist() if entry.filename.lower().endswith(".zip")]


def is_folder(path: str) -> bool:
    system, inner = file_system(path)
    return system.get_file_info(inner).type == fs.FileType.Directory


def folder_files(path: str) -> dict[str, dict[str, tuple[str, int]]]:
    """Of an unpacked archive: path and size of the expected files of every member, in the order of the members' names."""
    system, inner = file_system(path)
    root = inner.rstrip("/")
    found: dict[str, dict[str, tuple[str, int]]] = {}
    for entry in sorted(system.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda e: e.path):
        file = entry.base_name.lower()
        if entry.type == fs.FileType.File and file in dict(FILES):
            below = entry.path[: -len(entry.base_name)].rstrip("/").removeprefix(root).strip("/")
            place = f"{path.rstrip('/')}/{below}/{entry.base_name}" if below else f"{path.rstrip('/')}/{entry.base_name}"
            # Folders below one that is named like an inner ZIP belong to that member.
            inside = re.match(r"(?i)(.*?\.zip)(/|$)", below)
            member = inside.group(1) if inside else below or root.rsplit("/", 1)[-1]
            found.setdefault(member, {})[file] = (place, entry.size)
    return dict(sorted(found.items()))


def list_members(path: str) -> list[str]:
    """Names of the members of an archive, or of an unpacked one (a folder)."""
    return [name for name, _ in sized_members(path)]


def sized_members(path: str) -> list[tuple[str, int]]:
    """Names of the members of an archive, or of an unpacked one (a folder), and their bytes there."""
    if is_folder(path):
        return [(name, sum(size for _, size in files.values())) for name, files in folder_files(path).items()]
    with open_archive(path) as outer:
        return [(entry.filename, entry.compress_size) for entry in members_of(outer)]


def bundles(sizes: list[list[int]], least_tasks: int) -> list[list[int]]:
    """For the members' bytes of each archive: the task of each member, numbered within the archive, neighbours together."""
    costs = [[size + MEMBER_BYTES for size in archive] for archive in sizes]
    alone = sum(map(len, sizes)) <= least_tasks
    share = min(TASK_BYTES, sum(map(sum, costs)) // max(least_tasks, 1))
    found = []
    for archive in costs:
        most = max(share, sum(archive) // ARCHIVE_TASKS)
        tasks, held = [], 0
        for cost in archive:
            fits = bool(tasks) and not alone and held + cost <= most
            tasks.append(tasks[-1] if fits else tasks[-1] + 1 if tasks else 0)
            held = held + cost if fits else cost
        found.append(tasks)
    return found


class NestedZipSource(DataSource):
    """Options: ``path`` or ``archivos`` (JSON list of ``{path, fecha, omitir}``), ``lectura``, ``csv``, ``tareas``, ``recorte``.

    ``fecha`` forces the publication date of an archive, ``omitir`` lists dates whose members are not
    opened. ``csv`` restricts the emitted rows to one file. Members share a task only beyond ``tareas`` tasks. With ``recorte`` (true)
    the fields of rows come without surrounding whitespace.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> NestedZipReader:
        return NestedZipReader(dict(self.options))


class NestedZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        if "archivos" in options:
            self.archives = json.loads(options["archivos"])
        else:
            self.archives = [{"path": options["path"], "fecha": options.get("fecha")}]
        self.mode = options.get("lectura", LOAD)
        self.only = options.get("csv")
        self.least_tasks = int(options.get("tareas", LEAST_TASKS))
        self.trimmed = options.get("recorte") == "true"
        if self.mode not in (MEMBERS, HEADERS, LOAD, INSPECT):
            raise ValueError(f"unknown reading mode: {self.mode}")

    def partitions(self) -> list[MemberPartition | BundlePartition]:
        if self.mode == MEMBERS:
            return [MemberPartition(a["path"], None, i, i) for i, a in enumerate(self.archives)]
        with ThreadPoolExecutor(16) as pool:
            listed = list(pool.map(lambda a: sized_members(a["path"]), self.archives))
        opened, sizes = [], []
        for i, (archive, members) in enumerate(zip(self.archives, listed)):
            skip = set(archive.get("omitir") or ())
            wanted = [
                (MemberPartition(archive["path"], name, order, archive.get("lugar", i)), size)
                for order, (name, size) in enumerate(members)
                if (archive.get("fecha") or date_in_name(name)) not in skip
            ]
            opened.append([part for part, _ in wanted])
            sizes.append([size for _, size in wanted])
        parts = []
        for members, tasks in zip(opened, bundles(sizes, self.least_tasks)):
            together: dict[int, list[MemberPartition]] = {}
            for part, task in zip(members, tasks):
                together.setdefault(task, []).append(part)
            parts += [BundlePartition(bundle) for bundle in together.values()]
        return parts

    def read(self, part: MemberPartition | BundlePartition | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # Spark's stand-in when there is nothing to read
            return
        if self.mode == MEMBERS:
            yield from self._names(part)
            return
        yield from merged(self._bundle(part.members if isinstance(part, BundlePartition) else [part]))

    def _bundle(self, members: list[MemberPartition]) -> Iterator[pa.RecordBatch]:
        with open_archive(members[0].zip) as outer:
            listed = members_of(outer)
            for member in members:
                # By its place: a name alone would give the last member of that name.
                yield from self._member(member, outer, listed[member.order])

    def _member(self, part: MemberPartition, outer: zipfile.ZipFile, entry: zipfile.ZipInfo) -> Iterator[pa.RecordBatch]:
        with tempfile.SpooledTemporaryFile(SPOOL_BYTES) as raw:
            try:
                with outer.open(entry) as packed:
                    shutil.copyfileobj(packed, raw, 1 << 20)
                if not raw.tell():
                    yield note(part, "miembro", "vacio")
                    return
                raw.seek(0)
                with zipfile.ZipFile(raw) as inner:
                    yield from self._files(part, inner)
                yield note(part, "miembro", "ok")
            except zipfile.BadZipFile:
                yield note(part, "miembro", "corrupto")
            except Exception as problem:  # one broken member must not end the scan
                yield note(part, "miembro", "error", error=describe(problem))

    def _names(self, part: MemberPartition) -> Iterator[pa.RecordBatch]:
        try:
            names = list_members(part.zip)
            for at in range(0, len(names), BATCH_ROWS):
                here = [MemberPartition(part.zip, name, at + i, part.archive) for i, name in enumerate(names[at : at + BATCH_ROWS])]
                yield pa.Table.from_batches([note(member, "miembro", "ok") for member in here]).combine_chunks().to_batches()[0]
        except Exception as problem:
            yield note(part, "miembro", "error", error=describe(problem))

    def _files(self, part: MemberPartition, inner: zipfile.ZipFile) -> Iterator[pa.RecordBatch]:
        """Rows and notes of the expected files of one opened member."""
        by_name = {n.rsplit("/", 1)[-1].lower(): n for n in inner.namelist() if not n.endswith("/")}
        for file, header in FILES:
            wanted = self.only in (None, file)
            if file not in by_name:
                if wanted:
                    yield note(part, "csv", "falta", file)
            else:
                # A load for one file still walks the files before it: they can end the member.
                state, fields, error = yield from self._rows(part, inner, by_name[file], file, header, wanted)
                if wanted or state not in ("ok", "vacio"):
                    yield note(part, "csv", state, file, fields, error)
                if self.mode != INSPECT and state not in ("ok", "vacio"):
                    return
            if self.mode == LOAD and file == self.only:
                return

    def _rows(self, part, inner, name, file, header, wanted):
        """Emit the rows of one file; return its state, header and error."""
        found = None
        try:
            with inner.open(name) as raw:
                # Of a file whose header alone counts no more is read than one.
                records = Records(raw, block_bytes=READ_BYTES if self.mode == HEADERS else None, trimmed=self.trimmed)
                found = records.header()
                if found is None:
                    return "vacio", None, None
                found = [column.strip() for column in found]
                if self.mode != INSPECT and found != header:
                    return "encabezado", found, f"{UNKNOWN_HEADER}{found}"
                if self.mode == HEADERS:
                    return "ok", found, None
                for rows in records:
                    if wanted and len(rows):
                        yield row_batch(part, file, rows)
            state, error = "ok", None
        except zipfile.BadZipFile as problem:
            state, error = "corrupto", describe(problem)
        except Exception as problem:
            state, error = "error", describe(problem)
        return state, found, error


class Records:
    """The records of a pipe-separated file as arrays of lists of fields, without blank ones.

    The standard library's reader decides what a record is. Where no field begins with a quote it does no more than split lines and
    fields, so blocks of lines without such a field are split by array operations; others go through the reader itself, which takes
    further blocks while a quoted field is open. ``trimmed`` fields are without surrounding whitespace.
    """

    def __init__(self, raw, at_start: bool = True, block_bytes: int | None = None, trimmed: bool = False):
        self.texts = self._texts(raw, at_start, block_bytes or BLOCK_BYTES)
        self.first = ""
        self.trimmed = trimmed

    def header(self) -> list[str] | None:
        self.first = next(self.texts, None)
        if self.first is None:
            return None
        row = next(self._read(self.first), None)
        self.first = self.source.read()
        return row

    def __iter__(self) -> Iterator[pa.ListArray]:
        for text in chain([self.first], self.texts):
            for rows in self._parsed(text):
                yield trimmed(rows) if self.trimmed else rows

    @staticmethod
    def _blocks(raw, at_start: bool, block_bytes: int) -> Iterator[bytes]:
        """Whole lines, ``block_bytes`` or a little more at a time; what was read before a failure comes before it."""
        parts, size = [], 0
        while True:
            problem = None
            try:
                data = raw.read(READ_BYTES)
            except Exception as failed:
                data, problem = b"", failed
            if at_start and data:
                data, at_start = data.removeprefix(b"\xef\xbb\xbf"), False
            parts.append(data)
            size += len(data)
            if data and size < block_bytes:
                continue
            block = b"".join(parts)
            # A carriage return at the very end may be half of a line's end.
            cut = max(block.rfind(b"\n"), block.rfind(b"\r", 0, -1)) + 1
            if problem:
                yield block[:cut]
                raise problem
            if not data:
                yield block
                return
            yield block[:cut]
            parts, size = [block[cut:]], len(block) - cut

    def _texts(self, raw, at_start: bool, block_bytes: int) -> Iterator[str]:
        before = 0
        for block in self._blocks(raw, at_start, block_bytes):
            try:
                text = block.decode()
            except UnicodeDecodeError as problem:
                # Bytes that are no text spoil the whole read in which they come.
                spoiled = (before + problem.start) // READ_BYTES * READ_BYTES
                good = block[: max(spoiled - before, 0)]
                good = good[: max(good.rfind(b"\n"), good.rfind(b"\r", 0, -1)) + 1]
                if good:
                    yield good.decode()
                raise
            before += len(block)
            if text:
                yield text

    def _parsed(self, text: str) -> Iterator[pa.ListArray]:
        if '"' not in text or not (text.startswith('"') or any(mark in text for mark in ('|"', '\n"', '\r"'))):
            lines = [line for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n") if line]
            if lines and max(map(len, lines)) <= csv.field_size_limit():
                for at in range(0, len(lines), BATCH_ROWS):
                    yield pc.split_pattern(pa.array(lines[at : at + BATCH_ROWS], pa.string()), "|")
                return
        rows: list[list[str]] = []
        for row in self._read(text):
            if row:
                rows.append(row)
                if len(rows) >= BATCH_ROWS:
                    yield pa.array(rows, pa.list_(pa.string()))
                    rows = []
        yield pa.array(rows, pa.list_(pa.string()))

    def _read(self, text: str) -> Iterator[list[str]]:
        """Records of a block by the standard reader, to the end of the one in which the block ends."""
        self.source, inside = io.StringIO(text, newline=""), False

        def lines() -> Iterator[str]:
            nonlocal inside
            while True:
                line = self.source.readline()
                if line:
                    inside = True
                    yield line
                elif inside and (more := next(self.texts, None)) is not None:
                    self.source = io.StringIO(more, newline="")
                else:
                    return

        for row in csv.reader(lines(), delimiter="|"):
            inside = False
            yield row


def trimmed(rows: pa.ListArray) -> pa.ListArray:
    """The same lists with fields as ``cleaning.stripped`` leaves them."""
    return pa.ListArray.from_arrays(rows.offsets, pc.utf8_trim(rows.values, characters=WHITESPACE))


def describe(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def note(part, kind, state, file=None, fields=None, error=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [
            {
                "zip": part.zip,
                "archivo_origen": part.member,
                "orden": part.order,
                "csv": file,
                "tipo": kind,
                "estado": state,
                "campos": fields,
                "error": error,
                "archivo": part.archive,
            }
        ],
        schema=ARROW_SCHEMA,
    )


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches: members of few rows and single notes would each cost a batch on its way to Spark."""
    held, rows, size = [], 0, 0
    for batch in batches:
        if held and (rows + batch.num_rows > BATCH_ROWS or size + batch.nbytes > MERGED_BYTES):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows, size = [], 0, 0
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def row_batch(part: MemberPartition, file: str, rows: pa.ListArray) -> pa.RecordBatch:
    def constant(value, kind=pa.string()):
        return pa.repeat(pa.scalar(value, kind), len(rows))

    return pa.RecordBatch.from_arrays(
        [
            constant(part.zip),
            constant(part.member),
            constant(part.order, pa.int32()),
            constant(file),
            constant("fila"),
            constant(None),
            rows,
            constant(None),
            constant(part.archive, pa.int32()),
        ],
        schema=ARROW_SCHEMA,
    )


#: What tells a member from all others: its archive, that one's place in the scan, and its own place in the archive.
MEMBER = ["zip", "archivo", "orden"]


def broken_members(notes: DataFrame) -> DataFrame:
    """``MEMBER`` of those that could not be read to their end or have an unknown header."""
    fatal = ((F.col("tipo") == "miembro") & (F.col("estado") != "ok")) | (
        (F.col("tipo") == "csv") & F.col("estado").isin("encabezado", "error", "corrupto")
    )
    return notes.where(fatal).select(*MEMBER).distinct()


def whole_members(raw: DataFrame, notes: DataFrame | None = None) -> DataFrame:
    """A scan, or a stored one, without the rows of broken members.

    ``notes`` are those of a stored scan: there the broken members, no more than the driver has listed, are read at once and go to all
    tasks, and its rows stay where they are. Other scans are read to their end for them.
    """
    broken = broken_members(raw.where(F.col("tipo") != "fila")) if notes is None else F.broadcast(broken_members(notes))
    return raw.where(F.col("tipo") == "fila").join(broken, MEMBER, "left_anti")


# Workers need no installed copy of the package: the source travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_archives(
    spark: SparkSession,
    archives: list[str] | list[dict],
    mode: str = LOAD,
    csv_name: str | None = None,
    trimmed: bool = False,
) -> DataFrame:
    """Raw rows and notes of one or more archives (paths, or ``{path, fecha, omitir}`` entries); ``trimmed``: without surrounding whitespace."""
    spark.dataSource.register(NestedZipSource)
    entries = [a if isinstance(a, dict) else {"path": str(a)} for a in archives]
    reader = spark.read.format(FORMAT).option("archivos", json.dumps(entries)).option("lectura", mode)
    reader = reader.option("tareas", 4 * spark.sparkContext.defaultParallelism).option("recorte", trimmed)
    return (reader.option("csv", csv_name) if csv_name else reader).load()
