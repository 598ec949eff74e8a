"""Small tables for the tests of the training-data operators."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
SMALL = "/root/testdata/sf0.001"
AWKWARD = [
    (1, "one two three", "en", "a", 13),
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (None, "no id here at all", "en", "b", 17),
    (4, "one two three", "en", "a", 13),
    (4, "one two three", "en", "a", 13),
    (5, " \t\n\x0b\x0c\r ", None, "b", 7),
    (6, "word " * 30_000, "en", "c", 150_000),
    (7, "x" * 120_000, None, "c", 120_000),
    (8, "日本語のテキスト。" * 5000, "ja", "é", 45_000),
    (9, "a<|endoftext|>b 'stuff' it's 12345   \U0001f600 <|endoftext|>", "en", "b", 40),
    (10, "123 456 !!! ???", "en", "", 15),
]


def documents(spark, rows=AWKWARD):
    return spark.createDataFrame(rows, DOCUMENTS)


def with_clashes(frame, *names):
    """The frame with extra columns that are named like results."""
    for name in names:
        frame = frame.selectExpr("*", f"'x' as `{name}`")
    return frame


def text_of(row):
    return row["text"] or ""
