"""Corpus pipeline: stages over ``documents``, each one operator of ``duelframe.llm``.

Every stage but the last returns the columns of documents.  Rows with a null
id or text, repeated rows and extra columns pass through as each operator's
docstring states; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm import decontaminate, mixing, secrets, simhash, toxicity
from duelframe.llm.common import fold_remainder, join_on, row_key, save

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose toxicity score is at least 1/2; the others stay as they are."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    field = toxicity.fit(docs, labels, learn=fold_remainder("doc_id", 5) != 0)
    return toxicity.score(docs, field, carry=COLUMNS).where("predicted = 0").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component, the one with the smallest id.

    A row is named by its id and its text's digest, ids that are null last,
    so components of rows without ids keep one row too and repeated rows one
    of them (the first by source, language and size, nulls before others).
    """
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), row_key(F.col("text")).alias("key"))
    named = simhash.near_duplicates(docs.select("text", name.alias("name")), id_col="name", shingle=3, max_bits=2)
    keep = named.where("name = component_id").select("name.id", "name.key").distinct()
    keyed = docs.select(*COLUMNS).withColumn("key", row_key(F.col("text"))).withColumn("id", F.col("doc_id"))
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    one = join_on(keyed, keep, ["id", "key"], "left_semi").groupBy("id", "key").agg(
        F.min("text").alias("text"), F.min(F.struct(*rest)).alias("rest"))
    return one.select(F.col("id").alias("doc_id"), "text", "rest.*").select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the contamination rule marks; the others stay as they are."""
    bench = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    marked = decontaminate.digest(decontaminate.contamination(docs, bench, carry=COLUMNS))
    return marked.where("not contaminated").select(*COLUMNS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every reported secret in the texts; n_chars follows where a text changed."""
    clean = secrets.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("redacted"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with their sizes, targets, copies and words taken; the others go."""
    name = F.struct(F.col("doc_id").alias("id"), row_key(F.col("text")).alias("key"))
    mixed = mixing.mix(docs.select("text", "source", name.alias("name")), id_col="name").where("copies > 0")
    mixed = mixed.select("name.id", "name.key", "source", "size", "source_size", "target", "copies", "taken")
    keyed = docs.select(*COLUMNS).withColumn("key", row_key(F.col("text"))).withColumn("id", F.col("doc_id"))
    once = keyed.dropDuplicates(["id", "key", "source"])
    return join_on(mixed, once, ["id", "key", "source"]).select(*COLUMNS, "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("source_mixing", mixing_stage),
]

#: SQL cannot express the trained field of the first stage nor XXH64 fingerprints; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each stage's rows are written and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = save(docs, f"stage-{name}")
    return docs
