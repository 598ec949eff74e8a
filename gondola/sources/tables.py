"""Tables in a folder: reading, creating, appending, replacing, exporting.

A table is a Parquet folder below one root that all executors reach. Base tables and the larger marts
are partitioned by publication date, so date filters prune files. Whatever replaces rows goes through
:mod:`gondola.sources.replacement`: a failure at any point leaves the old rows or the new ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gondola.schemas import BRANCHES, CHAINS, DATE, FACT, TABLES, BaseTables
from gondola.sources.nested_zip import file_system
from gondola.sources.replacement import MAX_FILE_ROWS, UNDATED, Agreed, Replacement, agreements, listed, recover

REQUIRED_TABLES = tuple(TABLES)


class Warehouse:
    """Named tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        agreed = next((tables[table] for tables in agreements(self.root).values() if table in tables), None)
        frame = self._with_agreed(table, agreed) if agreed else self._scan(table, self.path(table))
        if table in TABLES:
            return frame.select(*TABLES[table].output)
        # Reading puts a partition column last; every mart starts with the date.
        return frame.select(DATE, *[c for c in frame.columns if c != DATE])

    def _scan(self, table: str, folder: str, *files: str) -> DataFrame:
        reader = self.spark.read.option("basePath", folder)
        if table in TABLES:
            reader = reader.schema(TABLES[table].schema)
        return reader.parquet(*[f"{folder}/{f}" for f in files] or [folder])

    def _with_agreed(self, table: str, agreed: Agreed) -> DataFrame:
        """A table in the middle of a replacement: what stays of it, and the new files in either place."""
        here, waiting = listed(self.path(table)), [f for f in listed(agreed.folder) if f in set(agreed.files)]
        parts = []
        stays = [f for f in here if f.endswith(".parquet") and not agreed.replaces(f) and not (f in agreed.files and not f.startswith(UNDATED))]
        moved = [f for f in here if f in set(agreed.files) and not f.startswith(UNDATED)]
        if stays:
            kept = F.col(DATE).isNull() | ~F.col(DATE).isin([date.fromisoformat(d) for d in agreed.dates])
            parts.append(self._scan(table, self.path(table)).where(kept))
        for folder, files in ((self.path(table), moved), (agreed.folder, waiting)):
            if files:
                parts.append(self._scan(table, folder, *files))
        if not parts:
            return self._scan(table, self.path(table))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def exists(self, table: str) -> bool:
        system, inner = file_system(self.path(table))
        return system.get_file_info(inner).type == fs.FileType.Directory or any(table in a for a in agreements(self.root).values())

    def missing(self, tables: Iterable[str] = REQUIRED_TABLES) -> list[str]:
        return sorted(t for t in set(tables) if not self.exists(t))

    def require(self, tables: Iterable[str] = REQUIRED_TABLES) -> None:
        missing = self.missing(tables)
        if missing:
            raise RuntimeError(f"these tables do not exist below {self.root}: {', '.join(missing)}")

    def base(self) -> BaseTables:
        self.require()
        return BaseTables(self.read(FACT), self.read(CHAINS), self.read(BRANCHES))

    def create_base(self, replace: bool = False) -> None:
        """Make the base tables that do not exist yet, or all of them anew."""
        for table, spec in TABLES.items():
            if replace or not self.exists(table):
                empty = self.spark.createDataFrame([], spec.schema)
                empty.write.mode("overwrite").partitionBy(DATE).parquet(self.path(table))

    def append(self, table: str, rows: DataFrame, *metrics) -> dict:
        """Append rows to a base table; returns ``filas`` and further metrics observed while writing."""
        observed = Observation()
        counted = rows.observe(observed, F.count(F.lit(1)).alias("filas"), *metrics)
        # A large member is spread over tasks, and a large date over files.
        (
            counted.select(*TABLES[table].output)
            .hint("rebalance", F.col(DATE))
            .write.mode("append")
            .option("maxRecordsPerFile", MAX_FILE_ROWS)
            .partitionBy(DATE)
            .parquet(self.path(table))
        )
        try:
            return observed.get
        except Py4JJavaError:
            # Spark drops the counting from a plan whose input it finds empty; nothing else may pass.
            if not rows.isEmpty():
                raise
            return {}

    def replace(self, table: str, frame: DataFrame, by_date: bool = False) -> int:
        """Create or replace a table and return its row count."""
        return self._replaced(table, frame, None, by_date)

    def replace_dates(self, table: str, frame: DataFrame, dates: Iterable[date]) -> int:
        """Replace some dates of a table partitioned by date; returns the rows these have now. The frame may read the table itself."""
        return self._replaced(table, frame, dates, True)

    def _replaced(self, table: str, frame: DataFrame, dates: Iterable[date] | None, by_date: bool) -> int:
        change = Replacement(self.root)
        try:
            rows = change.stage(table, frame, dates, by_date)["filas"]
            change.commit()
        finally:
            change.discard()
        return rows

    def store(self, name: str, frame: DataFrame) -> DataFrame:
        """Write a frame into a new folder and read it back."""
        frame.write.option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(self.path(name))
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def recover(self) -> None:
        """Finish or undo what a writer left that died. Every replacement begins with it."""
        recover(self.root)

    def dates(self, table: str) -> list[date]:
        """Publication dates of a table with at least one file, from a listing of its folder alone."""
        system, inner = file_system(self.path(table))
        found = system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
        days = set()
        for entry in found:
            value = re.search(rf"/{DATE}=(\d{{4}}-\d{{2}}-\d{{2}})/[^/_.][^/]*$", entry.path)
            if value and entry.size:
                days.add(date.fromisoformat(value[1]))
        return sorted(days)

    def drop_folder(self, name: str) -> None:
        system, inner = file_system(self.path(name))
        if system.get_file_info(inner).type == fs.FileType.Directory:
            system.delete_dir(inner)


def export_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)


def export_parquet(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").parquet(path)


def export(warehouse: Warehouse, table: str, folder: str) -> None:
    """Both exports of a written table."""
    frame = warehouse.read(table)
    export_csv(frame, f"{folder}/{table}.csv")
    export_parquet(frame, f"{folder}/{table}.parquet")
