"""Replacing dates of tables, or whole tables, all at once or not at all.

New files are written into a folder of their own below ``_pendientes`` first. Then one small file, the agreement, names them and what they
replace, for any number of tables. Before it stands nothing has changed; once it stands everything has: readers take the agreed files from
wherever they are, and the next writer finishes what is left (``recover``). Finishing deletes the replaced files and moves the new ones, file by
file and under the same names, so it can be broken off and repeated on any file system.

There is one writer at a time. A frame planned before a replacement may miss files that were deleted since; it has to be read again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gondola.schemas import DATE
from gondola.sources.nested_zip import file_system

PENDING = "_pendientes"
AGREEMENT = "acuerdo.json"
UNDATED = f"{DATE}=__HIVE_DEFAULT_PARTITION__"
#: Upper bound of rows per written file, so that one large member does not become one huge file.
MAX_FILE_ROWS = 20_000_000
#: Files that are deleted or moved at a time.
AT_ONCE = 16


@dataclass
class Agreed:
    """What an agreement says of a table: the replaced dates (None: all of it) and the new files, by their paths within the table."""

    folder: str
    dates: list[str] | None
    files: list[str]

    def replaces(self, path: str) -> bool:
        """Whether an old file goes. Rows without a date are added to those there are."""
        first, _, rest = path.partition("/")
        if not rest:  # files beside the partitions: an empty table's columns, Spark's mark of success
            return self.dates is None or (bool(self.files) and not first.startswith("_"))
        return self.dates is None or first in {f"{DATE}={day}" for day in self.dates}


def listed(path: str) -> list[str]:
    """Paths of all files below a folder, within it."""
    system, inner = file_system(path)
    found = system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
    inner = inner.rstrip("/")
    return sorted(f.path[len(inner) + 1 :] if f.path.startswith(inner) else f.path for f in found if f.type == fs.FileType.File)


def is_data(path: str) -> bool:
    return not path.rsplit("/", 1)[-1].startswith(("_", "."))


def delete_folder(path: str) -> None:
    system, inner = file_system(path)
    if system.get_file_info(inner).type == fs.FileType.Directory:
        system.delete_dir(inner)


def agreements(root: str) -> dict[str, dict[str, Agreed]]:
    """Agreements that are not finished: pending folder -> table -> what is agreed."""
    found = {}
    system, inner = file_system(f"{root}/{PENDING}")
    for entry in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        path = f"{entry.path}/{AGREEMENT}"
        if system.get_file_info(path).type == fs.FileType.File:
            with system.open_input_stream(path) as stream:
                tables = json.loads(stream.read())
            folder = f"{root}/{PENDING}/{entry.base_name}"
            found[folder] = {t: Agreed(f"{folder}/{t}", a["fechas"], a["archivos"]) for t, a in tables.items()}
    return found


def finish(root: str, table: str, agreed: Agreed) -> None:
    """Make a table what was agreed; may be repeated."""
    target = f"{root}/{table}"
    system, inner = file_system(target)
    staged = file_system(agreed.folder)[1]
    system.create_dir(inner, recursive=True)
    new = set(agreed.files)
    old = [path for path in listed(target) if agreed.replaces(path) and path not in new]
    waiting = [path for path in listed(agreed.folder) if path in new]
    for folder in {path.rpartition("/")[0] for path in waiting} - {""}:
        system.create_dir(f"{inner}/{folder}", recursive=True)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(lambda path: remove(system, f"{inner}/{path}"), old))
        list(pool.map(lambda path: move(system, f"{staged}/{path}", f"{inner}/{path}"), waiting))
    left = {path.partition("/")[0] for path in listed(target)}
    for folder in {path.partition("/")[0] for path in old if "/" in path} - left:
        delete_folder(f"{target}/{folder}")


def remove(system: fs.FileSystem, path: str) -> None:
    system.delete_file(path)


def move(system: fs.FileSystem, source: str, target: str) -> None:
    system.move(source, target)


def recover(root: str) -> None:
    """Finish what was agreed; drop what was only prepared."""
    for folder, tables in agreements(root).items():
        complete(root, folder, tables)
    delete_folder(f"{root}/{PENDING}")


def complete(root: str, folder: str, tables: dict[str, Agreed]) -> None:
    for table, agreed in tables.items():
        finish(root, table, agreed)
    system, inner = file_system(folder)
    # The agreement goes first: what is left then is a folder of nothing agreed.
    system.delete_file(f"{inner}/{AGREEMENT}")
    system.delete_dir(inner)


class Replacement:
    """New contents of some tables, prepared with ``stage`` and ``stage_file``, put in place with ``commit``."""

    def __init__(self, root: str):
        recover(root)
        self.root = root
        self.folder = f"{root}/{PENDING}/{uuid.uuid4().hex}"
        self.tables: dict[str, list[str] | None] = {}

    def stage(
        self,
        table: str,
        frame: DataFrame,
        dates: Iterable[date] | None = None,
        by_date: bool = True,
        metrics: Iterable[Column] = (),
        without: Iterable[str] = (),
        together: bool = False,
    ) -> dict:
        """Write new rows of a table; returns ``filas`` and further metrics observed while writing.

        With ``dates`` these are replaced, else the whole table. Columns named in ``without`` serve the metrics only. Partitioned output
        is rebalanced by date first: dates with few rows share no task with others, dates with very many rows are split over several. Where
        the rows of a date come ``together`` that is spared: a task writes a file for each of the few dates it reads.
        """
        path = f"{self.folder}/{table}"
        days = None if dates is None else sorted({str(day) for day in dates})
        observed = Observation()
        counted = frame.observe(observed, F.count(F.lit(1)).alias("filas"), *metrics).drop(*without)
        dealt = counted if together or not by_date else counted.hint("rebalance", F.col(DATE))
        writer = (dealt.write.partitionBy(DATE) if by_date else dealt.write).option("maxRecordsPerFile", MAX_FILE_ROWS)
        writer.parquet(path)
        files = [f for f in listed(path) if is_data(f)]
        if days is not None:
            strangers = {f.partition("/")[0] for f in files} - {f"{DATE}={day}" for day in days} - {UNDATED}
            if strangers:
                raise ValueError(f"rows of other dates than those to replace in {table}: {', '.join(sorted(strangers))}")
        if not files:
            # A partitioned write of nothing leaves no file to read the columns from. Beside partitions such a file is not read.
            frame.sparkSession.createDataFrame([], counted.schema).coalesce(1).write.mode("overwrite").parquet(path)
        self.tables[table] = days
        try:
            return observed.get
        except Py4JJavaError:
            # Spark drops the counting from a plan whose input it finds empty; nothing else may pass.
            if files and not frame.isEmpty():
                raise
            return {"filas": 0}

    def stage_file(self, table: str, name: str, content: bytes) -> None:
        """A small file as the only one of a folder."""
        system, inner = file_system(f"{self.folder}/{table}")
        system.create_dir(inner, recursive=True)
        with system.open_output_stream(f"{inner}/{name}") as out:
            out.write(content)
        self.tables[table] = None

    def commit(self) -> None:
        agreed = {t: {"fechas": days, "archivos": [f for f in listed(f"{self.folder}/{t}") if is_data(f)]} for t, days in self.tables.items()}
        system, inner = file_system(self.folder)
        with system.open_output_stream(f"{inner}/_{AGREEMENT}") as out:
            out.write(json.dumps(agreed).encode())
        move(system, f"{inner}/_{AGREEMENT}", f"{inner}/{AGREEMENT}")
        complete(self.root, self.folder, {t: Agreed(f"{self.folder}/{t}", a["fechas"], a["archivos"]) for t, a in agreed.items()})

    def discard(self) -> None:
        """Drop what was prepared, unless it is agreed."""
        system, inner = file_system(self.folder)
        if system.get_file_info(f"{inner}/{AGREEMENT}").type == fs.FileType.NotFound:
            delete_folder(self.folder)
