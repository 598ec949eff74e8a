import hashlib
from collections import defaultdict

import numpy as np
import pytest
import zstandard

from gondola.llm import warc
from gondola.llm.queries import op4_warc

from .helpers import SMALL

PAGES = "page_id long, url string, html string, digest string"


def expected(rows):
    first = defaultdict(list)
    for r in rows:
        if r["page_id"] is not None:
            first[r["html"] or ""].append(r["page_id"])
    out = []
    for r in rows:
        payload = r["html"] or ""
        least = min(first[payload], default=None)
        revisit = len(payload.encode()) >= 100 and least is not None and r["page_id"] != least
        out.append((r["page_id"], len(payload.encode()), hashlib.sha256(payload.encode()).hexdigest(), "revisit" if revisit else "response", least if revisit else None))
    return sorted(out, key=str)


def test_given_table(spark):
    rows = op4_warc(spark, SMALL).collect()
    assert sorted(map(tuple, rows), key=str) == expected(spark.read.parquet(f"{SMALL}/pages.parquet").collect())


def awkward(spark):
    copy, long = "<p>" + "same " * 50, "<p>" + "é" * 3_000_000
    rows = [
        (1, "http://a/\r\n x: y", copy, "x"), (2, None, copy, "x"), (2, None, copy, "x"), (3, "http://b/ ü", None, "x"), (4, "u", "", "x"), (5, "u", "tiny", "x"),
        (6, "u", "tiny", "x"), (7, "u", long, "x"), (8, "u", long, "x"), (None, "u", copy, "x"), (None, "u", "only without id " * 20, "x"), (9, "u", "WARC/1.1\r\n\r\n", "x"),
        (1, "http://a/", copy, "x"),
    ]
    return spark.createDataFrame(rows, PAGES)


def test_awkward_rows(spark):
    pages = awkward(spark)
    folder, index = warc.write(pages, archive_bytes=2_000_000)
    assert sorted(map(tuple, warc.read(folder, index).collect()), key=str) == expected(pages.collect())
    assert index.select("archive").distinct().count() > 1
    folder, index = warc.write(spark.createDataFrame([], PAGES))
    assert warc.read(folder, index).count() == 0


def test_one_record_needs_one_frame(spark):
    pages = awkward(spark)
    folder, index = warc.write(pages)
    row = index.where("page_id = 5").first()
    reader = warc.Reader(folder, row.archive)
    headers, block = warc.parse(reader.frame(row.frame)[row.place : row.place + row["size"]])
    assert block.endswith(b"\r\n\r\ntiny") and headers["x-page"] == "5" and headers["warc-record-id"] == row.record_id
    assert [r.page_id for r in warc.read(folder, index.where("page_id in (5, 8)")).orderBy("page_id").collect()] == [5, 8]


def test_archives_are_plain_zstandard_and_damage_is_seen(tmp_path):
    rng = np.random.default_rng(3)
    payloads = [rng.bytes(n) for n in (10, 400_000, 700_000, 3_000_000, 0)]
    folder = f"file://{tmp_path}"
    writer, whole, places = warc.Writer(folder, "a.warc.zst"), b"", []
    for i, p in enumerate(payloads):
        data = warc.record(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), None)
        places.append(writer.add(data))
        whole += data
    writer.close()
    packed = (tmp_path / "a.warc.zst").read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(packed, read_across_frames=True).read() == whole
    reader = warc.Reader(folder, "a.warc.zst")
    assert [warc.result(reader.frame(f)[a : a + n])[1] for f, a, n in places] == [len(p) for p in payloads]
    with pytest.raises(ValueError, match="damaged"):
        warc.result(warc.record(1, "u", b"x" * 200, "0" * 64, None))
