"""Corpus pipeline: the stages a training corpus passes, in order.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns the documents that go on.  ``run`` applies them to ``documents``, writing
each stage's result under the shared folder and reading it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import bpe, mixing, secret_scan, simhash, toxicity
from farebox.llm.catalog import vocabulary_path
from farebox.llm.common import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents scored as toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out())
    return toxicity.toxicity(docs, labels, COLUMNS).filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near-duplicates the smallest doc_id stays."""
    return simhash.deduplicated(docs.select(*COLUMNS))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: secrets are replaced by a mark; n_chars follows the text."""
    found = secret_scan.scan(docs.select(*COLUMNS))
    kind = docs.schema["n_chars"].dataType
    out = found.select("doc_id", secret_scan.redacted(F.col("text"), F.col("spans")).alias("text"), "lang", "source",
                       "n_chars", (F.size("spans") > 0).alias("changed"))
    size = F.when(F.col("changed"), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", size).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: rows of a document as often as its source's weight asks for; every
    document at least once."""
    return mixing.repeated(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token ids of every text."""
    out = bpe.encode(docs.select("doc_id", "source", "text"), vocabulary_path())
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", clean), ("simhash", distinct), ("secrets", redacted), ("mix", mixed), ("bpe", tokens)]

#: SQL can't express the models and the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
