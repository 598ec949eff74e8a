"""The block-wise reader of pipe-separated files gives what the standard reader gives."""

import csv
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from gondola.functions import cleaning
from gondola.functions.cleaning import WHITESPACE
from gondola.sources import nested_zip
from gondola.sources.nested_zip import Records


def standard(data):
    rows = csv.reader(io.TextIOWrapper(io.BytesIO(data), encoding="utf-8-sig", newline=""), delimiter="|")
    header = next(rows, None)
    return header, [row for row in rows if row]


def blockwise(data):
    records = Records(io.BytesIO(data))
    header = records.header()
    return header, [row for rows in records for row in rows.to_pylist()] if header is not None else []


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_random_files(monkeypatch, size):
    monkeypatch.setattr(nested_zip, "BLOCK_BYTES", size)
    monkeypatch.setattr(nested_zip, "READ_BYTES", 16)
    draw = random.Random(size)
    parts = ["a", "|", "|", "\r\n", "\n", "\r", '"', '""', '|"', '"|', "ñ", "\U0001f600", " ", "\x0b", "\x1c", " ", "\x85", "12\" pizza", '\n"x\ny"|z\n', "\x00"]
    for _ in range(600):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(40)))
        data = (b"\xef\xbb\xbf" if draw.random() < 0.3 else b"") + text.encode()
        assert blockwise(data) == standard(data), text


def test_a_blank_first_line_is_the_header():
    assert blockwise(b"\nid|x\n1|2\n") == ([], [["id", "x"], ["1", "2"]]) == standard(b"\nid|x\n1|2\n")
    assert blockwise(b"") == (None, [])


def test_very_long_fields_are_refused_as_ever():
    data = b"h\n" + b"x" * (csv.field_size_limit() + 1) + b"\n"
    with pytest.raises(csv.Error):
        blockwise(data)


@pytest.mark.parametrize("size", [32, 1 << 20])
def test_rows_before_a_break_are_kept(monkeypatch, size):
    monkeypatch.setattr(nested_zip, "BLOCK_BYTES", size)
    monkeypatch.setattr(nested_zip, "READ_BYTES", 8)
    lines = [f"{i}|x" for i in range(50)]
    data = ("\r\n".join(["h|h", *lines]) + "\r\n" * 5 + "51|").encode() + b"\xff|rest\r\n52|y\r\n"
    records, found = Records(io.BytesIO(data)), []
    records.header()
    with pytest.raises(UnicodeDecodeError):
        for rows in records:
            found += rows.to_pylist()
    assert found == [line.split("|") for line in lines]

    class Broken(io.BytesIO):
        def read(self, n=-1):
            part = super().read(n)
            if not part:
                raise zipfile.BadZipFile("CRC")
            return part

    records, found = Records(Broken("\n".join(["h|h", *lines, "51|cut"]).encode())), []
    records.header()
    with pytest.raises(zipfile.BadZipFile):
        for rows in records:
            found += rows.to_pylist()
    assert found == [line.split("|") for line in lines]


def test_trimmed_fields_are_as_the_cleaning_leaves_them(spark):
    marks = [*WHITESPACE, "\x00", "\u200b", "\ufeff", "ñ", "\U0001f600"]
    fields = [f"{a}{b}x y{b}{a}" for a in marks for b in marks if not {a, b} & {"\n", "\r"}] + ["", " ", "\u3000\t", "a"]
    # Lines split by array operations, and quoted ones that the reader takes.
    for made in ("|".join(fields), "|".join(f'"{field}"' for field in fields)):
        found = [row for part in Records(io.BytesIO(f"{made}\n|\n".encode()), trimmed=True) for row in part.to_pylist()]
        want = spark.createDataFrame(list(enumerate(fields)), "i int, value string").select("i", cleaning.stripped(F.col("value"))).sort("i").collect()
        assert found == [[r[1] for r in want], ["", ""]]
    assert [part.to_pylist() for part in Records(io.BytesIO(b""), trimmed=True)] in ([], [[]])
