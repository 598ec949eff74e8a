"""One query for each operator over its whole table, with production parameters; SQL where it can express one."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import bpe, chains, chat, machine, minhash, mixing, packing, permutation, phrases, ppm, repair, simhash, warc
from gondola.llm.common import bounded_batches, bounded_sample, stage, table

#: The folder of the public vocabulary files; an argument of ``bpe.encode``.
TOKENIZERS = os.environ.get("GONDOLA_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.json"
WORD_VOCABULARY = f"{TOKENIZERS}/word_bpe_49k.json"

#: Words that mark a labelled toxic row as one of a category (weak labels; the labels say only toxic or not).
INSULTS = ("idiot", "moron", "clown", "loser", "scum", "stupid")
CONTEMPT = ("worthless", "trash", "disgusting", "pathetic")
TOXIC_FROM = 0.5


def remainder(doc_id: str, by: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(by))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), ["doc_id"])


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
    return rows.withColumn("spans", spans)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(*warc.write(table(spark, sf_dir, "pages")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hexadecimal(F.col("code")).alias("fingerprint"), "component_id")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode(table(spark, sf_dir, "documents"), ["doc_id"], VOCABULARY)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def weak_categories(labels: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, insult, contempt, toxic of the labelled rows."""
    words = F.split(F.lower("text"), r"[^\p{L}]+")
    told = docs.select("doc_id", *[F.arrays_overlap(words, F.array(*map(F.lit, w))).alias(n) for n, w in (("insult", INSULTS), ("contempt", CONTEMPT))])
    known = labels.where(F.col("toxic").isNotNull()).join(told, "doc_id")
    toxic = F.col("toxic") == 1
    return known.select("doc_id", *[(toxic & F.coalesce(n, F.lit(False))).cast("int").alias(n) for n in ("insult", "contempt")], F.col("toxic").cast("int").alias("toxic"))


def toxicity(docs: DataFrame, labels: DataFrame, scored: DataFrame, keep: list[str], names: list[str] | None = None) -> DataFrame:
    """Learn from the labelled rows of ``docs`` that are not held out, score ``scored``."""
    rows = docs.where(remainder("doc_id", 5) != 0).select("doc_id", "text")
    # Labels first: a bounded sample of them, then their texts and the categories these tell.
    picked = bounded_sample(labels.where(F.col("toxic").isNotNull()).select("doc_id", "toxic").where(remainder("doc_id", 5) != 0), "toxic", chains.SAMPLE)
    texts = stage(rows.join(F.broadcast(picked.select("doc_id")), "doc_id"), "toxic-sample")
    shares = labels.where("toxic is not null and toxic in (0, 1)").agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    chain = chains.train(texts, weak_categories(picked, texts), ["insult", "contempt", "toxic"], prior=shares)
    return chains.predict(scored, chain, keep, names)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = toxicity(docs, table(spark, sf_dir, "labels"), docs, ["doc_id"])
    return rows.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "insult", "contempt", F.col("toxic").alias("score"), (F.col("toxic") >= TOXIC_FROM).cast("int").alias("predicted"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return permutation.search(rows, rows.where(F.pmod("vec_id", F.lit(50)) == 0))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ppm.train(docs.where(remainder("doc_id", 3) != 1))
    rows = ppm.predict(docs, model, ["doc_id"])
    return rows.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 5) == 0
    learned = machine.train(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    rows = machine.score(docs, learned, ["doc_id"])
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.read(*packing.write(table(spark, sf_dir, "documents"), WORD_VOCABULARY))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with the faults that their keys' checksums name; a dropped one stays as a row that says so."""
    blank = F.lit(" ")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.summaries(damaged(table(spark, sf_dir, "conversations")), "dropped")


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_chat, op3_fingerprints, op4_warc, op5_simhash, op6_bpe, op7_toxicity, op8_permutation_index, op9_language, op10_quality,
        op11_collocations, op12_packing, op13_repair,
    )
}
ORACLE_SQL = {"op1_mixing": mixing.ORACLE, "op2_chat": chat.ORACLE, "op11_collocations": phrases.ORACLE}
