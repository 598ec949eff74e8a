"""Date-incremental load of archives into the base tables, with a control table.

Archives are loaded in the given order. Neighbouring archives whose publication dates do not overlap
cannot influence each other, so they are loaded by the same jobs: a backfill of thousands of daily
archives keeps the cluster busy with all their members at once.

A batch is read once, into a folder of the warehouse with a part for each file; all else comes from there.
The dates that it brings are replaced in all three tables and in the ledger of loads at once
(:mod:`gondola.sources.replacement`): a load that dies leaves the old rows or the new ones, and the same call
makes it good.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gondola.functions.cleaning import clean_columns, in_columns, publication_date
from gondola.plans import freshness
from gondola.schemas import CONTROL_SCHEMA, DATE, FACT, TABLES
from gondola.sources.nested_zip import MEMBER, MEMBERS, broken_members, read_archives, whole_members
from gondola.sources.pipe_files import read_sources
from gondola.sources.replacement import Replacement
from gondola.sources.tables import Warehouse, export

CONTROL = "control_ingestas"
#: Every message of every load; the control table keeps their number and the first ones.
ERRORS = "errores_ingesta"
STAGING = "_carga"
#: Archives per job; their row counts are observed one by one.
BATCH_ARCHIVES = 32
DETAILED_ERRORS = 100

# Load states, load modes and messages kept in the control table.
RUNNING = "running"
SUCCESS = "success"
WITH_WARNINGS = "success_with_warnings"
SKIPPED = "skipped"
FAILED = "failed"
REPLACE = "replace"
APPEND = "append"
ALREADY_LOADED = "Fechas ya cargadas; no se insertaron filas nuevas."
EMPTY_MEMBER = "ValueError: ZIP interno vacio."
CORRUPT_MEMBER = "ZIP interno corrupto."


class UnreadableArchive(RuntimeError):
    """The outer archive cannot be opened; the message is the original problem."""


@dataclass
class Archive:
    """One archive of a load with what its listing says."""

    path: str
    forced: str | None = None
    dates: set[str] = field(default_factory=set)
    error: str | None = None
    mode: str = APPEND
    id: str = field(default_factory=lambda: str(uuid.uuid4()))
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(TABLES, 0))
    loaded: set[date] = field(default_factory=set)

    def source(self, skip: Iterable[str] = ()) -> dict:
        return {"path": self.path, "fecha": self.forced, "omitir": sorted(skip)}


# --- control table: events are appended, the latest one per load is its state


def _record(warehouse: Warehouse, events: Sequence[dict]) -> None:
    """Append control events; fields an event does not mention are NULL."""
    rows = [tuple(event.get(f.name) for f in CONTROL_SCHEMA) for event in events]
    frame = warehouse.spark.createDataFrame(rows, CONTROL_SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(warehouse.path(CONTROL))


def _event(archive: Archive, state: str, started: datetime, **values) -> dict:
    return {
        "id_ingesta": archive.id,
        "started_at": started,
        "zip_path": archive.path,
        "zip_filename": archive.path.rsplit("/", 1)[-1],
        "modo_carga": archive.mode,
        "estado": state,
        **{f"filas_{table}": archive.counts[table] for table in TABLES},
        "errores": 0,
        **values,
    }


def control_table(warehouse: Warehouse) -> DataFrame:
    """Latest state of every load. A finished event replaces the running one of the same load."""
    names = CONTROL_SCHEMA.names
    events = warehouse.spark.read.schema(CONTROL_SCHEMA).parquet(warehouse.path(CONTROL))
    # The running event has no end time and therefore sorts first.
    latest = events.groupBy("id_ingesta").agg(F.max_by(F.struct(*names), F.struct("finished_at")).alias("e"))
    return latest.select("e.*")


# --- planning


def offered_dates(members: DataFrame, forced: Column | None = None) -> DataFrame:
    """Publication dates of listed members, NULL for members without one."""
    return members.select("zip", "archivo_origen", publication_date(F.col("archivo_origen"), forced).alias("fecha"))


def forced_dates(archives: Sequence[Archive]) -> Column | None:
    """The forced date of the archive a row comes from."""
    forced = {a.path: a.forced for a in archives if a.forced}
    if not forced:
        return None
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in forced.items() for x in pair]), F.col("zip"))


def plan(spark: SparkSession, entries: Sequence[tuple[date | str | None, str]]) -> list[Archive]:
    """List all archives (central directories only) and note their dates."""
    archives = [Archive(str(path), str(forced) if forced else None) for forced, path in entries]
    listed = read_archives(spark, [a.source() for a in archives], MEMBERS)
    found = listed.groupBy("zip").agg(
        F.max(F.when(F.col("estado") == "error", F.col("error"))).alias("error"),
        F.collect_set(publication_date(F.col("archivo_origen")).cast("string")).alias("fechas"),
        F.count_if(F.col("estado") == "ok").alias("miembros"),
    )
    by_path = {row["zip"]: row for row in found.collect()}
    for archive in archives:
        row = by_path.get(archive.path)
        if row:
            archive.error = row["error"]
            archive.dates = set(row["fechas"])
        if archive.forced:
            archive.dates = {archive.forced} if row and row["miembros"] else set()
    return archives


def batches(archives: Sequence[Archive], size: int = BATCH_ARCHIVES) -> list[list[Archive]]:
    """Runs of neighbouring archives that share no date and are all readable."""
    runs: list[list[Archive]] = []
    taken: set[str] = set()
    paths: set[str] = set()
    for archive in archives:
        joins = (
            runs
            and len(runs[-1]) < size
            and not archive.error
            and not runs[-1][-1].error
            and not (taken & archive.dates)
            and archive.path not in paths
        )
        if not joins:
            runs.append([])
            taken, paths = set(), set()
        runs[-1].append(archive)
        taken |= archive.dates
        paths.add(archive.path)
    return runs


# --- loading


def load_archives(
    warehouse: Warehouse,
    entries: Sequence[tuple[date | str | None, str]],
    mode: str = APPEND,
    reload_existing: bool = False,
    export_to: str | None = None,
    split_members: bool = False,
) -> dict[str, int]:
    """Load archives, given as (forced date or None, path), in order; returns rows per base table.

    A path may be that of a folder with unpacked files (:mod:`gondola.sources.pipe_files`), which are split over tasks. With
    ``split_members`` archives are unpacked in the warehouse's folder first and read like that: for members too large for a task.

    ``replace`` starts all tables anew before the first archive. Dates already in the price table are
    skipped, or with ``reload_existing`` replaced where the archive has readable members for them. An
    archive that fails is recorded as failed; the others are loaded, then the first problem is raised.
    """
    archives, problems = load(warehouse, entries, mode, reload_existing, split_members)
    if export_to:
        for table in TABLES:
            export(warehouse, table, export_to)
    if problems:
        raise problems[0]
    return {table: sum(a.counts[table] for a in archives) for table in TABLES}


def load(
    warehouse: Warehouse,
    entries: Sequence[tuple[date | str | None, str]],
    mode: str = APPEND,
    reload_existing: bool = False,
    split_members: bool = False,
) -> tuple[list[Archive], list[Exception]]:
    """The archives of a load with their counts and the dates they brought, and the problems of those that failed."""
    if mode not in (REPLACE, APPEND):
        raise ValueError(f"unknown load mode: {mode}")
    archives = plan(warehouse.spark, entries) if entries else []
    if mode == REPLACE and archives:
        archives[0].mode = REPLACE
    problems = [p for run in batches(archives) for p in _load_apart(warehouse, run, reload_existing, split_members)]
    return archives, problems


def _load_apart(warehouse: Warehouse, run: list[Archive], reload_existing: bool, split_members: bool) -> list[Exception]:
    """Load a batch, or if that fails its archives one by one; returns their problems."""
    try:
        _load(warehouse, run, reload_existing, split_members)
        return []
    except Exception as problem:
        if len(run) == 1:
            return [problem]
        return [p for archive in run for p in _load_apart(warehouse, [archive], reload_existing, split_members)]


def _load(warehouse: Warehouse, run: list[Archive], reload_existing: bool, split_members: bool) -> None:
    started = datetime.now(timezone.utc)
    # What a load left behind that died counts, or does not, before dates are compared.
    warehouse.recover()
    replace = run[0].mode == REPLACE
    if replace or not warehouse.exists(CONTROL):
        empty = warehouse.spark.createDataFrame([], CONTROL_SCHEMA)
        empty.write.mode("overwrite").parquet(warehouse.path(CONTROL))
    _record(warehouse, [_event(archive, RUNNING, started) for archive in run])

    skipped: set[str] = set()
    staging = f"{STAGING}/{uuid.uuid4().hex}"
    try:
        if run[0].error:
            raise UnreadableArchive(run[0].error)
        offered = set().union(*(a.dates for a in run))
        loaded = set() if replace or not warehouse.exists(FACT) else {d.isoformat() for d in warehouse.dates(FACT)}
        if reload_existing:
            loaded -= offered
        skipped = offered & loaded
        how = {"split_members": True} if split_members else {}
        stored = store(warehouse, [a.source(a.dates & loaded) for a in run], staging, **how)
        notes = stored.where(F.col("tipo") != "fila")
        dates = {(r["zip"], r["fecha"]) for r in processed_dates(notes, forced_dates(run)).collect()}
        warehouse.create_base()
        _write_tables(warehouse, run, stored, dates, replace)
        for archive in run:
            archive.loaded = {day for path, day in dates if path == archive.path}
        _finish(warehouse, run, loaded, notes, dates, started)
    except Exception as problem:
        if len(run) == 1:
            text = str(problem) if isinstance(problem, UnreadableArchive) else f"{type(problem).__name__}: {problem}"
            event = _event(
                run[0],
                FAILED,
                started,
                finished_at=datetime.now(timezone.utc),
                fechas_publicacion=json.dumps(sorted(skipped & run[0].dates)),
                errores=1,
                detalle=json.dumps({"detalle": None, "errores": [text]}),
            )
            _record(warehouse, [event])
        raise
    finally:
        warehouse.drop_folder(staging)


def store(warehouse: Warehouse, sources: list[dict], name: str, split_members: bool = False) -> DataFrame:
    """Read archives once and store rows and notes, apart by kind and file, fields in columns of their own."""
    path = warehouse.path(f"{name}/filas")
    scan = read_sources(warehouse.spark, sources, warehouse.path(f"{name}/desempacado"), split_members, trimmed=True)
    stored = in_columns(scan, TABLES.values())
    stored.write.partitionBy("tipo", "csv").parquet(path)
    return warehouse.spark.read.schema(stored.schema).parquet(path)


def _write_tables(warehouse: Warehouse, run: list[Archive], stored: DataFrame, dates: set[tuple[str, date]], replace: bool) -> None:
    """Replace the dates in the base tables, or the tables, and note the loads; row counts per archive are observed during the write.

    Rows without a date are added to those there are. A task that read an archive of one date stored its rows in files of their own, so they
    come together by date.
    """
    together = max(Counter(path for path, _ in dates).values(), default=0) <= 1
    whole = whole_members(stored, stored.where(F.col("tipo") != "fila"))
    from_archive = [F.count_if(F.col("archivo") == i).alias(f"a{i}") for i in range(len(run))]
    undated = F.count_if(F.col(DATE).isNull()).alias("sin_fecha")
    id_of = {archive.path: archive.id for archive in run}
    entries = {day.isoformat(): id_of[path] for path, day in dates}
    change = Replacement(warehouse.root)
    try:
        for table, spec in TABLES.items():
            rows = clean_columns(whole, spec, forced_dates(run))
            columns = [*spec.output, "archivo"]
            days = None if replace else {day for _, day in dates}
            seen = change.stage(table, rows.select(columns), days, metrics=[*from_archive, undated], without=["archivo"], together=together)
            for i, archive in enumerate(run):
                archive.counts[table] = seen.get(f"a{i}", 0)
            if seen.get("sin_fecha"):
                entries[freshness.UNDATED] = run[-1].id
        freshness.stage(change, freshness.LOADS, entries if replace else freshness.loads(warehouse) | entries)
        change.commit()
    finally:
        change.discard()


def load_errors(notes: DataFrame) -> DataFrame:
    """Messages of a load, in archive, member and file order."""
    member, state = F.col("archivo_origen"), F.col("estado")
    is_member = F.col("tipo") == "miembro"
    message = (
        F.when(is_member & (state == "vacio"), F.concat(member, F.lit(f": {EMPTY_MEMBER}")))
        .when(state == "corrupto", F.concat(member, F.lit(f": {CORRUPT_MEMBER}")))
        .when(state == "falta", F.concat(member, F.lit(": falta "), F.col("csv")))
        .otherwise(F.concat(member, F.lit(": "), F.col("error")))
    )
    return (
        notes.where((F.col("tipo") != "fila") & ~state.isin("ok") & ~(~is_member & (state == "vacio")))
        .select("zip", "archivo", "orden", F.coalesce("csv", F.lit("")).alias("csv"), message.alias("mensaje"))
    )


def processed_dates(notes: DataFrame, forced: Column | None = None) -> DataFrame:
    """Dates of the members that were read to their end, per archive."""
    members = notes.where(F.col("tipo") != "fila").select(*MEMBER, "archivo_origen").distinct()
    whole = members.join(broken_members(notes), MEMBER, "left_anti")
    day = publication_date(F.col("archivo_origen"), forced)
    return whole.select("zip", day.alias("fecha")).where(F.col("fecha").isNotNull()).distinct()


def load_state(rows: int, skipped: int, errors: int) -> str:
    """State of a finished load: nothing loaded and something skipped, errors, or neither."""
    if not rows and skipped:
        return SKIPPED
    return WITH_WARNINGS if errors else SUCCESS


def _finish(
    warehouse: Warehouse, run: list[Archive], loaded: set[str], notes: DataFrame, dates: set[tuple[str, date]], started: datetime
) -> None:
    """Final control rows of a batch, and all its messages."""
    errors = load_errors(notes)
    ids = F.array(*[F.lit(a.id) for a in run])
    messages_of = errors.select(F.element_at(ids, F.col("archivo") + 1).alias("id_ingesta"), "zip", "orden", "csv", "mensaje")
    messages_of.coalesce(1).write.mode("append").parquet(warehouse.path(ERRORS))
    totals = {r["zip"]: r["n"] for r in errors.groupBy("zip").agg(F.count("*").alias("n")).collect()}
    in_order = Window.partitionBy("zip").orderBy("orden", "csv", "mensaje")
    first = errors.withColumn("puesto", F.row_number().over(in_order)).where(F.col("puesto") <= DETAILED_ERRORS)
    messages: dict[str, list[str]] = {}
    for row in first.orderBy("zip", "puesto").collect():
        messages.setdefault(row["zip"], []).append(row["mensaje"])
    events = []
    for archive in run:
        count = totals.get(archive.path, 0)
        skipped = archive.dates & loaded
        state = load_state(sum(archive.counts.values()), len(skipped), count)
        detail = {
            "detalle": ALREADY_LOADED if state == SKIPPED else None,
            "errores": messages.get(archive.path, []),
        }
        events.append(
            _event(
                archive,
                state,
                started,
                finished_at=datetime.now(timezone.utc),
                fechas_publicacion=json.dumps(sorted(skipped | {day.isoformat() for path, day in dates if path == archive.path})),
                errores=count,
                detalle=json.dumps(detail),
            )
        )
    _record(warehouse, events)
