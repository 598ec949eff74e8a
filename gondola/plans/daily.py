"""The daily job: chosen archives in, marts of the loaded dates out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.plans import ingest
from gondola.plans.build import renew_marts
from gondola.plans.marts import BASKET_KEYWORDS
from gondola.sources.tables import Warehouse


def load_entries(resources: DataFrame, path: str) -> list[tuple[str, str]]:
    """Chosen resources (one row per date, column ``fecha``) as entries of a load.

    ``path`` says where the archive of a date lies, with ``{fecha}`` in it.
    """
    days = resources.where(F.col("fecha").isNotNull()).select(F.col("fecha").cast("string")).distinct().orderBy("fecha")
    return [(row[0], path.format(fecha=row[0])) for row in days.collect()]


def run_daily(
    warehouse: Warehouse,
    entries: Sequence[tuple[date | str | None, str]],
    mode: str = ingest.APPEND,
    reload_existing: bool = False,
    marts: bool = True,
    keywords: Sequence[str] = BASKET_KEYWORDS,
    split_members: bool = False,
) -> dict[str, dict[str, int]]:
    """Load archives and renew the marts wherever they are not of the latest load of a date.

    So a plain retry also builds what an earlier call left behind. Archives that fail do not keep the marts of the
    others from being built; the first problem is raised last.
    """
    archives, problems = ingest.load(warehouse, entries, mode, reload_existing, split_members)
    counts = {table: sum(a.counts[table] for a in archives) for table in ingest.TABLES}
    built = renew_marts(warehouse, keywords) if marts else {}
    if problems:
        raise problems[0]
    return {"tablas": counts, "marts": built}
