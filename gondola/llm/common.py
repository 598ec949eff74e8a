"""What the operators share: staged tables, text batches as byte arrays, hashed spans, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in slices of about so many bytes, so a task's memory does not follow the batch size.
SLICE_BYTES = 2_000_000
#: Bytes of a batch that goes to Python: texts are long, and a batch is held in several forms at a time.
BATCH_BYTES = 4 * 1024 * 1024
_local_folder: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """From now on batches have no more than ``BATCH_BYTES``; Spark's own bound is 64 MB, or ten thousand rows of any length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where it is unset, a local session gets a temporary folder; on a cluster it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    if not _local_folder:
        _local_folder.append("file://" + tempfile.mkdtemp(prefix="gondola-"))
    return _local_folder[0]


def new_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder below the shared one, as a full address, deleted when the session's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/gondola-{what}-{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return re.sub("^file:/+", "file:///", files.makeQualified(path).toString())


def stage(frame: DataFrame, what: str, file_rows: int = 0) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, and no lineage for a lost executor to recompute.

    ``file_rows`` bounds the rows of a file: for a few very long rows that tasks are to share.
    """
    spark = frame.sparkSession
    folder = f"{new_folder(spark, what)}/table"
    frame.write.option("maxRecordsPerFile", file_rows).parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def unused(name: str, columns: list[str]) -> str:
    """A column name that is not taken."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def slices(texts: list[bytes], most: int = SLICE_BYTES) -> Iterator[slice]:
    """Consecutive slices of about ``most`` bytes; a longer text is a slice of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, null as the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of a word of letters and digits: ASCII alphanumerics and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Spans:
    """The maximal runs of wanted bytes in a list of texts: ``starts`` and ``ends`` in ``data``, ``first[i]:first[i + 1]`` those of text i.

    ``data`` holds the texts one after another, each followed by a newline, and eight bytes of padding.
    """

    def __init__(self, texts: list[bytes], wanted: np.ndarray):
        self.data = np.frombuffer(b"\n".join([*texts, b"\0" * 8]), np.uint8)
        self.offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.offsets[1:])
        inside = np.zeros(self.offsets[-1] + 1, np.int8)
        inside[1:] = wanted[self.data[: self.offsets[-1]]]
        change = np.diff(inside)
        self.starts = np.flatnonzero(change == 1)
        self.ends = np.flatnonzero(change == -1)
        self.first = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (shift, multiply, shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes a step; ``data`` has eight bytes of padding."""
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    left = ends - starts
    out = mixed(left.astype(np.uint64) ^ (lanes[starts] & LOW_BYTES[np.minimum(left, 8)]))
    rest = np.flatnonzero(left > 8)
    at = starts[rest] + 8
    while len(rest):
        more = ends[rest] - at
        out[rest] = mixed(out[rest] * np.uint64(0x9E3779B97F4A7C15) ^ (lanes[at] & LOW_BYTES[np.minimum(more, 8)]))
        going = more > 8
        rest, at = rest[going], at[going] + 8
    return out


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, and where each text's begin.

    A text of fewer words has one shingle, its whole sequence; one without words has none.
    """
    counts = np.diff(first)
    several = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(several)])
    at = np.repeat(first[:-1] - begin[:-1], several) + np.arange(begin[-1])
    length = np.repeat(np.minimum(counts, width), several)
    out = length.astype(np.uint64)
    for j in range(width):
        use = j < length
        word = hashes[np.where(use, at + j, 0)] if len(hashes) else out
        out = np.where(use, out * np.uint64(0x9E3779B97F4A7C15) + word, out)
    return mixed(out), begin


def bounded_sample(frame: DataFrame, by: str, wanted: int, key: str = "doc_id", seed: str = "sample") -> DataFrame:
    """About ``wanted`` rows of each value of ``by`` (all where there are fewer), the same rows at every run.

    A row stays if its hash falls into the share of the hash range that its group needs, so the sample has the same bound at every size. Every
    value has its rows in it.
    """
    counts = frame.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("_rows"))
    counts = F.broadcast(counts)
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return frame.join(counts, by).where(place < F.lit(float(wanted)) / F.col("_rows")).drop("_rows")


def components(edges: DataFrame, what: str = "components") -> DataFrame:
    """(node, root) of every node of the edges ``u``, ``v`` (longs): root is the smallest node reachable.

    Alternates the large-star and small-star steps until nothing changes; every round is staged. Minima are combined before the shuffle
    and joined back, so a node with very many links is never one group.
    """
    spark = edges.sparkSession
    pair = [F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")]
    links = stage(edges.where("u <> v").select(*pair).distinct(), what)
    state = None
    while True:
        sums = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not sums.n:
            return spark.createDataFrame([], "node long, root long")
        if (sums.n, sums.s) == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = (sums.n, sums.s)
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, what)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v")
        links = stage(small.select(*pair).distinct(), what)
