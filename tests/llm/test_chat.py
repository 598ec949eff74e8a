from collections import defaultdict

import duckdb

from gondola.llm import chat
from gondola.llm.queries import op2_chat

from .helpers import SMALL

TURNS = "conv_id long, turn long, role string, text string, speaker string"


def expected(rows, part):
    """{(conv_id, speaker, part): (text, learned pieces)}"""
    conversations = defaultdict(list)
    for r in rows:
        conversations[r["conv_id"]].append(((r["turn"] is not None, r["turn"] or 0), r["role"] or "unknown", r["text"] or ""))
    out = {}
    for conv, turns in conversations.items():
        for speaker in {role for _, role, _ in turns} - {"system"}:
            for (has, turn), role, text in sorted(turns):
                key = conv, speaker, turn // part if has else 0
                whole, learned = out.get(key, ("", []))
                tag = "assistant" if role == speaker else "system" if role == "system" else f"user name={role}"
                out[key] = whole + f"<|im_start|>{tag}\n{text}<|im_end|>\n", learned + ([f"{text}<|im_end|>"] if role == speaker else [])
    return out


def check(spark, frame, part):
    got = {(r.conv_id, r.speaker, r.part): (r.text, [r.text[s.begin : s.end] for s in r.spans]) for r in chat.rotate(frame, part).collect()}
    assert got == expected(frame.collect(), part)


def test_given_table(spark):
    check(spark, spark.read.parquet(f"{SMALL}/conversations.parquet"), 1024)
    check(spark, spark.read.parquet(f"{SMALL}/conversations.parquet"), 3)


def test_awkward_rows(spark):
    rows = [
        (1, 0, "system", "be \U0001f600 kind", "x"), (1, 1, "ann", "hello", "x"), (1, 2, "bob", None, "x"), (1, 3, "cy", "ü" * 5000, "x"),
        (1, 3, "cy", "ü" * 5000, "x"), (1, None, "ann", "before", "x"), (2, 0, "system", "alone", "x"), (None, 0, None, "nobody", "x"), (3, 0, "ann", "", "x"),
    ]
    check(spark, spark.createDataFrame(rows, TURNS), 2)
    assert chat.rotate(spark.createDataFrame([], TURNS)).count() == 0


def test_query_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    frame = op2_chat(spark, SMALL)
    names = sorted(frame.columns)
    sql = connection.execute(f"select {', '.join(names)} from ({chat.ORACLE})").fetchall()
    assert sorted(map(tuple, frame.select(names).collect())) == sorted(sql)
