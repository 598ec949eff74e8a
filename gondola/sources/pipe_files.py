"""Pipe-separated files outside archives, read by many tasks each.

A folder is an unpacked archive: every folder below it that holds expected files is a member, named by its path (files that lie in
the folder itself are a member of the folder's name, what lies below a folder named like an inner ZIP is that member's). ``unpack`` makes such files of archives whose members are too large for a task.

A quoted field may hold line ends, so a line may begin inside of a record, and where a file can be cut depends on all quotes before.
Each part of a file is therefore scanned on its own for both cases: does it end inside of a quoted field if it begins outside, and if it
begins inside, where does that record end? These answers are maps of two states; a window over the parts of a file composes them, and
says for every part at which byte its first own record begins. Parts are then parsed apart, whole records each. Only files longer than a
part are scanned; a part costs two reads of its bytes and one parsing.

Defined results: files of no bytes are empty, as in archives; a record longer than a part belongs to the task in which it begins; a part
that cannot be read makes its member broken, wherever it lies. All problems of a member's files are noted, also those after the first.
"""

from __future__ import annotations

import csv
import io
import sys
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gondola.sources.nested_zip import (
    ARROW_SCHEMA,
    FILES,
    LOAD,
    SCHEMA,
    UNKNOWN_HEADER,
    MemberPartition,
    Records,
    bundles,
    date_in_name,
    describe,
    file_system,
    folder_files,
    is_folder,
    members_of,
    note,
    open_archive,
    read_archives,
    row_batch,
    sized_members,
)

PART_BYTES = 32 * 1024 * 1024
#: Most tasks of one job; a task takes several parts where there are more.
MOST_TASKS = 20_000
#: Bytes of one search for the end of a line.
WINDOW_BYTES = 1 << 16

MEMBER_COLUMNS = "zip string, archivo_origen string, orden int, archivo int"
FILE_COLUMNS = f"{MEMBER_COLUMNS}, csv string, ruta string, bytes long"
_EDGES = "ruta string, parte int, inicio long, abre boolean, sigue boolean, cierra long"
_UNPACKED = pa.schema([*ARROW_SCHEMA, ("ruta", pa.string()), ("bytes", pa.int64())])
FILE = "archivo"  # kind of the rows of ``unpack`` that name a file


# --- where records begin


def line_start(stream, at: int, size: int) -> int:
    """The first byte at or after ``at`` that begins a line (``\\n``, ``\\r\\n`` or ``\\r`` end one), or the size."""
    if at <= 0:
        return 0
    at -= 1
    while at < size:
        window = stream.read_at(min(WINDOW_BYTES, size - at), at)
        feed = window.find(b"\n")
        end = feed if feed >= 0 else len(window)
        lone = window.find(b"\r", 0, end)
        if 0 <= lone < end - 1:
            return at + lone + 1
        if feed >= 0:
            return at + feed + 1
        if at + len(window) >= size:
            return size
        # Its last byte again: where that is a carriage return, the next one decides.
        at += max(len(window) - 1, 1)
    return size


def ends_open(text: str, first_only: bool = False) -> tuple[bool, int | None]:
    """Whether a text of whole lines ends inside of a quoted field, and the length of its first record, if that ends in it."""
    source = io.StringIO(text, newline="")
    inside, over, read, first = False, False, 0, None

    def lines() -> Iterator[str]:
        nonlocal inside, over, read
        while line := source.readline():
            inside = True
            read += len(line)
            yield line
        # Asked for more within a record: a quoted field is open.
        over = inside

    for _ in csv.reader(lines(), delimiter="|"):
        inside = False
        if first is None and not over:
            first = read
            if first_only:
                break
    return over, first


def edges(data: bytes) -> tuple[bool, bool, int | None]:
    """Of whole lines: do they end inside of a quoted field if they begin outside; if they begin inside; where does that record end?"""
    if b'"' not in data:
        return False, True, None
    # One character a byte: neither marks nor line ends are part of longer characters in UTF-8.
    text = data.decode("latin-1")
    opens = text.startswith('"') or any(mark in text for mark in ('|"', '\n"', '\r"'))
    limit = csv.field_size_limit(sys.maxsize)
    try:
        left = opens and ends_open(text)[0]
        stays, first = ends_open('"' + text, first_only=not opens)
    finally:
        csv.field_size_limit(limit)
    return left, stays and (opens or first is None), None if first is None else first - 1


def _scan_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            system, inner = file_system(row["ruta"])
            with system.open_input_file(inner) as stream:
                begin = line_start(stream, row["parte"] * row["tramo"], row["bytes"])
                end = line_start(stream, (row["parte"] + 1) * row["tramo"], row["bytes"])
                left, stays, closes = edges(stream.read_at(end - begin, begin) if end > begin else b"")
            found = {
                "ruta": [row["ruta"]],
                "parte": [row["parte"]],
                "inicio": [begin],
                "abre": [left],
                "sigue": [stays],
                "cierra": [None if closes is None else begin + closes],
            }
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found.values(), kinds, strict=True)], list(found))


def record_ranges(files: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``FILE_COLUMNS`` with ``desde`` and ``hasta``: ranges of bytes that hold whole records and make up each file."""
    whole = files.where(F.col("bytes") <= part_bytes).withColumns({"desde": F.lit(0).cast("long"), "hasta": F.col("bytes")})
    long = files.where(F.col("bytes") > part_bytes)
    last = F.floor((F.col("bytes") - 1) / F.lit(part_bytes)).cast("int")
    parts = long.select("ruta", "bytes", F.lit(part_bytes).cast("long").alias("tramo"), F.explode(F.sequence(F.lit(0), last)).alias("parte"))
    scanned = parts.repartition(tasks_for(long, part_bytes)).mapInArrow(_scan_edges, _EDGES)

    in_file = Window.partitionBy("ruta").orderBy("parte")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # A part sets the state, keeps it, or turns it over: the last set value, turned as often as parts have done so since.
    turns = (F.col("abre") & ~F.col("sigue")).cast("int")
    counted = scanned.withColumn("vueltas", F.sum(turns).over(in_file.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.when(F.col("abre") == F.col("sigue"), F.struct("parte", "vueltas", F.col("abre").cast("int").alias("estado")))
    counted = counted.withColumns({"fijo": F.max(fixed).over(before), "antes": F.coalesce(F.lag("vueltas").over(in_file), F.lit(0))})
    state = F.coalesce("fijo.estado", F.lit(0)) + F.col("antes") - F.coalesce("fijo.vueltas", F.lit(0))
    begun = counted.withColumn("desde", F.when(state % 2 != 0, F.col("cierra")).otherwise(F.col("inicio")))
    begun = begun.where(F.col("desde").isNotNull()).withColumn("siguiente", F.lead("desde").over(in_file))
    cut = long.join(begun.select("ruta", "desde", "siguiente"), "ruta").withColumn("hasta", F.coalesce("siguiente", "bytes"))
    return whole.unionByName(cut.where("desde < hasta").select(whole.columns))


def tasks_for(files: DataFrame, part_bytes: int) -> int:
    """As many tasks as the files have ``PART_BYTES``, or larger parts, but enough for all cores where there are as many parts.

    Smaller parts share tasks, and so do small files.
    """
    seen = files.agg(F.count("*").alias("n"), F.sum(F.ceil(F.col("bytes") / part_bytes)).alias("parts"), F.sum("bytes").alias("bytes")).first()
    parts = max(seen["n"], seen["parts"] or 0)
    cores = 4 * files.sparkSession.sparkContext.defaultParallelism
    return max(1, min(parts, max((seen["bytes"] or 0) // max(part_bytes, PART_BYTES) + 1, cores), MOST_TASKS))


# --- reading


class ByteRange:
    """Bytes of a file from one place to another as a stream."""

    def __init__(self, stream, at: int, end: int):
        self.stream, self.at, self.end = stream, at, end

    def read(self, size: int) -> bytes:
        data = self.stream.read_at(min(size, self.end - self.at), self.at) if self.at < self.end else b""
        self.at += len(data)
        return data


def _read_range(row: dict, trimmed: bool) -> Iterator[pa.RecordBatch]:
    part = MemberPartition(row["zip"], row["archivo_origen"], row["orden"], row["archivo"])
    file, found = row["csv"], None
    system, inner = file_system(row["ruta"])
    with system.open_input_file(inner) as stream:
        try:
            at_start = row["desde"] == 0
            records = Records(ByteRange(stream, row["desde"], row["hasta"]), at_start, trimmed=trimmed)
            if at_start:
                found = records.header()
                if found is None:
                    yield note(part, "csv", "vacio", file)
                    return
                found = [column.strip() for column in found]
                if found != dict(FILES)[file]:
                    yield note(part, "csv", "encabezado", file, found, f"{UNKNOWN_HEADER}{found}")
                    return
            for rows in records:
                if len(rows):
                    yield row_batch(part, file, rows)
            if at_start:
                yield note(part, "csv", "ok", file, found)
        except OSError:
            raise  # the file system's, not the content's: the task is tried again
        except Exception as problem:
            yield note(part, "csv", "error", file, found, describe(problem))


def _read_ranges(trimmed: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _read_range(row, trimmed)

    return read


def read_files(files: DataFrame, part_bytes: int = PART_BYTES, trimmed: bool = False) -> DataFrame:
    """Rows and notes of files (``FILE_COLUMNS``), as a load takes them; the schema is that of archives."""
    return record_ranges(files, part_bytes).repartition(tasks_for(files, part_bytes)).mapInArrow(_read_ranges(trimmed), SCHEMA)


# --- unpacked archives


def listed_members(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """``MEMBER_COLUMNS`` of the members of archives whose dates are not left out."""
    return spark.createDataFrame([row for archive in wanted_members(entries) for row, _ in archive], MEMBER_COLUMNS)


def wanted_members(entries: list[dict]) -> list[list[tuple[tuple, int]]]:
    """The rows of ``listed_members`` for each archive, and their bytes there."""
    with ThreadPoolExecutor(16) as pool:
        listed = list(pool.map(lambda e: sized_members(e["path"]), entries))
    found = []
    for entry, members in zip(entries, listed, strict=True):
        skip = set(entry.get("omitir") or ())
        rows = [((entry["path"], name, order, entry["lugar"]), size) for order, (name, size) in enumerate(members)]
        found.append([row for row in rows if (entry.get("fecha") or date_in_name(row[0][1])) not in skip])
    return found


def folder_listing(spark: SparkSession, entries: list[dict]) -> tuple[DataFrame, DataFrame]:
    """Files (``FILE_COLUMNS``) and notes of unpacked archives; only folders are read."""
    members = listed_members(spark, entries)
    with ThreadPoolExecutor(16) as pool:
        listed = list(pool.map(lambda e: folder_files(e["path"]), entries))
    rows = [
        (entry["path"], name, file, *place)
        for entry, members_here in zip(entries, listed, strict=True)
        for name, found in members_here.items()
        for file, place in found.items()
    ]
    there = spark.createDataFrame(rows, "zip string, archivo_origen string, csv string, ruta string, bytes long").distinct()
    expected = members.select("*", F.explode(F.array(*[F.lit(file) for file, _ in FILES])).alias("csv"))
    files = expected.join(there, ["zip", "archivo_origen", "csv"], "left")
    missing = files.where(F.col("ruta").isNull()).select(*_noted("csv", "falta"))
    return files.where(F.col("ruta").isNotNull()), members.select(*_noted("miembro", "ok")).unionByName(missing)


def _noted(kind: str, state: str) -> list:
    none = F.lit(None).cast("string")
    file = F.col("csv") if kind == "csv" else none.alias("csv")
    return [
        "zip",
        "archivo_origen",
        "orden",
        file,
        F.lit(kind).alias("tipo"),
        F.lit(state).alias("estado"),
        F.lit(None).cast("array<string>").alias("campos"),
        none.alias("error"),
        "archivo",
    ]


def _unpack(folder: str):
    def unpack_member(row: dict, outer: zipfile.ZipFile, listed: list[zipfile.ZipInfo]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = MemberPartition(row["zip"], row["archivo_origen"], row["orden"], row["archivo"])
        home = f"{folder}/{part.archive}/{part.order}"
        system, root = file_system(home)
        system.create_dir(root, recursive=True)
        state, error, file = "ok", None, None
        try:
            with outer.open(listed[part.order]) as packed:
                if not packed.read(1):
                    yield note(part, "miembro", "vacio")
                    return
                packed.seek(0)
                with zipfile.ZipFile(packed) as inner:
                    by_name = {n.rsplit("/", 1)[-1].lower(): n for n in inner.namelist() if not n.endswith("/")}
                    for file, _ in FILES:
                        if file not in by_name:
                            yield note(part, "csv", "falta", file)
                            continue
                        # A repeated task writes a file of its own and puts it in place in one step.
                        draft = f"{root}/{file}.{TaskContext.get().taskAttemptId()}"
                        with inner.open(by_name[file]) as source, system.open_output_stream(draft) as target:
                            size = 0
                            while data := source.read(1 << 20):
                                target.write(data)
                                size += len(data)
                        system.move(draft, f"{root}/{file}")
                        named = note(part, FILE, "ok", file).append_column("ruta", pa.array([f"{home}/{file}"]))
                        yield named.append_column("bytes", pa.array([size], pa.int64()))
                    file = None
        except zipfile.BadZipFile as problem:
            state, error = "corrupto", describe(problem) if file else None
        except Exception as problem:  # one broken member must not end the scan
            state, error = "error", describe(problem)
        yield note(part, "csv" if file else "miembro", state, file, None, error)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Members of one archive follow each other: its directory is read once for them.
        for path, rows in groupby((row for batch in batches for row in batch.to_pylist()), key=lambda row: row["zip"]):
            with open_archive(path) as outer:
                listed = members_of(outer)
                for made in (made for row in rows for made in unpack_member(row, outer, listed)):
                    if made.num_columns < len(_UNPACKED):
                        made = made.append_column("ruta", pa.nulls(1, pa.string())).append_column("bytes", pa.nulls(1, pa.int64()))
                    yield made.cast(_UNPACKED)

    return run


def unpack(spark: SparkSession, entries: list[dict], folder: str) -> tuple[DataFrame, DataFrame]:
    """Unpack archives into a folder that all executors reach, as streams; the files (``FILE_COLUMNS``) and notes.

    A task takes neighbouring members like the tasks that read archives, a single one where there are few.
    """
    archives = wanted_members(entries)
    tasks = bundles([[size for _, size in archive] for archive in archives], 4 * spark.sparkContext.defaultParallelism)
    rows, before = [], 0
    for archive, numbers in zip(archives, tasks, strict=True):
        rows += [(*row, before + number) for (row, _), number in zip(archive, numbers, strict=True)]
        before += numbers[-1] + 1 if numbers else 0
    members = spark.createDataFrame(rows, f"{MEMBER_COLUMNS}, tarea int")
    dealt = members.repartitionById(max(before, 1), "tarea").drop("tarea")
    done = dealt.mapInArrow(_unpack(f"{folder}/archivos"), f"{SCHEMA}, ruta string, bytes long")
    done.write.parquet(f"{folder}/listado")
    stored = spark.read.schema(done.schema).parquet(f"{folder}/listado")
    columns = [c.split()[0] for c in FILE_COLUMNS.split(", ")]
    return stored.where(F.col("tipo") == FILE).select(*columns), stored.where(F.col("tipo") != FILE).drop("ruta", "bytes")


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_sources(
    spark: SparkSession,
    sources: list[dict],
    folder: str | None = None,
    split_members: bool = False,
    part_bytes: int = PART_BYTES,
    trimmed: bool = False,
) -> DataFrame:
    """Rows and notes of archives and unpacked archives, as a load takes them; ``trimmed``: fields without surrounding whitespace.

    With ``split_members`` archives are unpacked into ``folder`` first, so that many tasks read one member.
    """
    entries = [{**source, "lugar": i} for i, source in enumerate(sources)]
    folders = [e for e in entries if is_folder(e["path"])]
    archives = [e for e in entries if e not in folders]
    scans = []
    if archives and not split_members or not entries:
        scans.append(read_archives(spark, archives, LOAD, trimmed=trimmed))
    elif archives:
        files, notes = unpack(spark, archives, folder)
        scans += [read_files(files, part_bytes, trimmed), notes]
    if folders:
        files, notes = folder_listing(spark, folders)
        scans += [read_files(files, part_bytes, trimmed), notes]
    whole = scans[0]
    for scan in scans[1:]:
        whole = whole.unionByName(scan)
    return whole
