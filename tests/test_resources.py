"""Choosing published resources."""

import json

import pytest

from gondola.sources import resources as k

RESOURCES = [
    {"id": "1", "name": "Precios 2026-05-20", "format": "ZIP", "url": "http://x/1", "last_modified": "2026-05-20T10:00:00"},
    {"id": "2", "name": "", "description": "Precios 2026-05-21", "format": "zip", "url": "http://x/2", "created": "2026-05-21T01:00:00Z"},
    {"id": "3", "name": "precios_2026-05-24", "format": "", "url": "http://x/a.ZIP", "last_modified": "", "metadata_modified": "2026-05-23T23:00:00-03:00"},
    {"id": "4", "name": "Precios 2026-05-20", "format": "zip", "url": "http://x/4", "last_modified": "2026-05-20T10:00:00"},
    {"id": "5", "name": "Precios 2026-05-22", "format": "csv", "url": "http://x/b.csv"},
    {"id": "6", "name": "Precios 2026-05-22", "format": "zip", "url": ""},
    {"id": "7", "name": "nada", "format": "zip", "url": "http://x/2026-05-19/c", "last_modified": "ayer"},
    {"id": "8", "name": "2026-02-30", "format": "zip", "url": "http://x/8"},
]


@pytest.fixture(scope="module")
def resources(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("json") / "paquete.json"
    path.write_text(json.dumps({"success": True, "result": {"resources": RESOURCES}}))
    return k.read_package(spark, str(path))


def ids(frame):
    return [r["id"] for r in frame.collect()]


def test_normalized(resources):
    rows = {r["id"]: r for r in resources.collect()}
    assert rows["2"]["name"] == "Precios 2026-05-21" and rows["7"]["created"] is None
    assert [rows[i]["posicion"] for i in "12345678"] == list(range(8))


def test_dates(resources):
    found = {r["id"]: str(r["fecha"]) for r in k.dated(resources).collect()}
    # An underscore glues the date to the word before it: the metadata time counts, in UTC.
    assert found == {
        "1": "2026-05-20", "2": "2026-05-21", "3": "2026-05-24", "4": "2026-05-20", "7": "2026-05-19", "8": "None",
    }


def test_selection(resources):
    assert ids(k.latest(resources)) == ["3"]
    assert ids(k.for_date(resources, "2026-05-20")) == ["1"]  # equal rank: the first listed
    assert ids(k.between_dates(resources, "2026-05-20", "2026-05-21")) == ["1", "2"]
    assert ids(k.recent(resources, 4)) == ["2", "3"]
    assert ids(k.recent(resources, 2, "2026-05-20")) == ["7", "1"]
    assert [str(r[0]) for r in k.available_dates(resources).collect()] == [
        "2026-05-19", "2026-05-20", "2026-05-21", "2026-05-24",
    ]


def test_errors(resources):
    with pytest.raises(ValueError):
        k.between_dates(resources, "2026-05-21", "2026-05-20")
    with pytest.raises(ValueError):
        k.recent(resources, 0)
    with pytest.raises(Exception, match="No ZIP resource for 2020-01-01"):
        k.for_date(resources, "2020-01-01").collect()
    nothing = resources.where("id = '5'")
    with pytest.raises(Exception, match="No resource is a ZIP archive"):
        k.latest(nothing).collect()
    with pytest.raises(Exception, match="No ZIP resource has a date"):
        k.recent(nothing, 3).collect()


def test_positions_follow_the_files_and_their_listings(spark, tmp_path):
    for name, ids in (("b.json", ["x", "y"]), ("a.json", ["z"])):
        listed = [{"id": i, "name": f"precios {i}.zip", "format": "ZIP"} for i in ids]
        (tmp_path / name).write_text(json.dumps({"result": {"resources": listed}}))
    rows = k.read_package(spark, str(tmp_path)).select("posicion", "id").collect()
    assert sorted(map(tuple, rows)) == [(0, "z"), (1, "x"), (2, "y")]
