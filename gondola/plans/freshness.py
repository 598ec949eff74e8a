"""Which load wrote the prices of a date, and from which load each mart was built.

The loads' ledger and one ledger a mart hold a load for every publication date; each is replaced together with the rows it speaks of, so a ledger is
never ahead of its table or behind it. A mart is stale at the dates where both differ, whatever died in between. A ledger has one entry a date:
small, and kept as one JSON file.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date

from pyarrow import fs

from gondola.schemas import FACT
from gondola.sources.nested_zip import file_system
from gondola.sources.replacement import Replacement
from gondola.sources.tables import Warehouse

FOLDER = "_frescura"
LOADS = "cargas"
FILE = "fechas.json"
#: Rows without a date, and dates that were loaded before there was a ledger.
UNDATED, EARLIER = "", "anterior"


def ledger(warehouse: Warehouse, name: str) -> dict[str, str]:
    """Date (ISO, or UNDATED) -> load."""
    system, inner = file_system(f"{warehouse.path(FOLDER)}/{name}/{FILE}")
    if system.get_file_info(inner).type != fs.FileType.File:
        return {}
    with system.open_input_stream(inner) as stream:
        return json.loads(stream.read())


def loads(warehouse: Warehouse) -> dict[str, str]:
    known = ledger(warehouse, LOADS)
    present = [day.isoformat() for day in warehouse.dates(FACT)] if warehouse.exists(FACT) else []
    return dict.fromkeys(present, EARLIER) | known


def stage(change: Replacement, name: str, entries: dict[str, str]) -> None:
    """Let a ledger be replaced together with other tables."""
    change.stage_file(f"{FOLDER}/{name}", FILE, json.dumps(entries, sort_keys=True).encode())


def stale(warehouse: Warehouse, marts: Iterable[str]) -> dict[str, set[str]]:
    """Dates at which a mart is not of the latest load, for the marts that have any. What a writer left is finished first."""
    warehouse.recover()
    latest = loads(warehouse)
    found = {}
    for mart in marts:
        built = ledger(warehouse, mart)
        days = {day for day in {*latest, *built} if latest.get(day) != built.get(day)}
        if days:
            found[mart] = days
    return found


def after_build(warehouse: Warehouse, mart: str, dates: Iterable[date] | None) -> dict[str, str]:
    """A mart's ledger once these dates (None: all) are built from the prices as they are."""
    latest = loads(warehouse)
    if dates is None:
        return latest
    days = {day.isoformat() for day in dates}
    return {d: load for d, load in ledger(warehouse, mart).items() if d not in days} | {d: latest[d] for d in days if d in latest}
