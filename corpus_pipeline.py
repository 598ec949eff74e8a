"""From raw documents to token ids: language, toxicity, near duplicates, mixture, encoding. Part of the subpackage ``gondola.llm``.

Each stage takes what the one before kept, as a written table; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import bpe, minhash, mixing, ppm, simhash
from gondola.llm.common import bounded_batches, components, stage, table, unused
from gondola.llm.queries import TOXIC_FROM, VOCABULARY, toxicity


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which no language can be told (no text or no letter); the trees learn from the rows that state theirs."""
    bounded_batches(spark)
    lang, score = unused("lang_pred", docs.columns), unused("lang_score", docs.columns)
    told = ppm.predict(docs, ppm.train(docs), docs.columns, (lang, score))
    return told.where(F.col(lang) != ppm.NONE).drop(lang, score)


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the last link of the chain finds toxic."""
    bounded_batches(spark)
    names = [unused(n, docs.columns) for n in ("insult", "contempt", "toxic")]
    scored = toxicity(docs, table(spark, sf_dir, "labels"), docs, docs.columns, names)
    return scored.where(F.col(names[-1]) < TOXIC_FROM).drop(*names)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id (null last, then by the text's hash).

    Fingerprints within two bits find copies and the slightest edits; a document whose shingles of five words are to 0.8 those of another
    often differs in more bits. Both kinds of links are sought among all documents of the input and joined to groups together.
    """
    bounded_batches(spark)
    text = F.xxhash64("text").alias("text")
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", text).alias("doc_id"), "text")
    signed = stage(minhash.signed_sets(named), "minhash")
    codes = stage(simhash.with_fingerprints(named, 3).groupBy(F.col("doc_id.text").alias("text_hash")).agg(F.min("code").alias("code")), "simhash")
    ends = signed.groupBy("text_hash").agg(F.min("class").alias("class")).join(codes, "text_hash")
    # Each fingerprint is named by its smallest class: its other classes are linked to that one.
    of_code = stage(ends.groupBy("code").agg(F.min("class").alias("class")), "simhash-classes")
    same = ends.join(of_code.withColumnRenamed("class", "v"), "code").select(F.col("class").alias("u"), "v").where("u <> v")
    u, v = of_code.select(F.col("code").alias("u"), F.col("class").alias("a")), of_code.select(F.col("code").alias("v"), F.col("class").alias("b"))
    close = simhash.code_links(of_code.select("code")).join(u, "u").join(v, "v").select("a", "b")
    links = minhash.class_links(named, signed, 0.8).union(same).union(close)
    roots = components(links, "near-links").toDF("class", "root")
    first = signed.groupBy("class").agg(F.min("doc_id").alias("first")).join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    return simhash.of_keys(docs, first.groupBy("root").agg(F.min("first").alias("first")).select("first"), signed)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their targets in whole documents; those that are taken twice are two rows."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (binary, little-endian unsigned 32-bit) and the text that these decode to."""
    bounded_batches(spark)
    rows = bpe.encode(docs, ["doc_id", "lang", "source"], VOCABULARY)
    return rows.withColumnRenamed("decoded", "text")


STAGES = [("language", language), ("toxicity", non_toxic), ("near_duplicates", distinct), ("mixture", mixture), ("tokens", tokens)]

#: SQL can express neither the trained models nor the fingerprints' hash; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
