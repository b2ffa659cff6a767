"""Registered queries of the training-data operators, with production parameters.

Each query applies its operator to its whole table and derives the digest
columns of its contract from the operator's results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import (bpe, ctw, forest, hnsw, html_text, lexical, mixing, oracle, phrases, runs, secret_scan, simhash,
                         tokenstore, toxicity)
from farebox.session import scratch_path

#: Vocabulary files are given by path and never copied into the repository.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: encode and decode every whole text."""
    return bpe.round_trip_digests(_table(spark, sf_dir, "documents"), vocabulary_path())


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: the 20 nearest of every row whose vec_id is divisible by 20."""
    return forest.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: every copy of the mix with its block and place."""
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: fingerprints and the components of their links."""
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: links of every vector within its label, and the components."""
    return hnsw.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: toxicity scores, learned outside the held-out rows."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = toxicity.toxicity(docs, labels.filter(~toxicity.held_out()))
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                      (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: write all documents' ids to a store and read it back."""
    out = scratch_path(spark, "token-store")
    tokenstore.write(_table(spark, sf_dir, "documents"), vocabulary_path(), out)
    return tokenstore.read(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: remove passages that start in an earlier document too."""
    out = phrases.deduplicated(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: base spans by kind and all spans."""
    out = secret_scan.scan(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", *[secret_scan.counted(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


def op10_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: unigram base and context-tree score of every whole text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", ctw.held_out().alias("held_out"))
    return ctw.score(docs).withColumn("bits_per_byte", ctw.bits_per_byte())


def op11_min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: the main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    out = html_text.extract(pages, html_text.train(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: periodic runs of every whole text and the text without its repeats."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = runs.collapsed_runs(docs.withColumn("text", runs.planted(F.col("doc_id"), F.col("text"))))
    best = runs.strongest(F.col("runs"))
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "collapsed", "runs", best.alias("best")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(runs.listed(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: the 50 best documents of every benchmark item."""
    out = lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 50)
    return out.select("item_id", "rank", "doc_id", "score")


QUERIES = [op1_bpe_round_trip, op2_prefix_forest, op3_source_mix, op4_simhash_near_dedup,
           op5_embedding_near_dedup, op6_toxicity, op7_token_store, op8_phrase_dedup,
           op9_secret_scan, op10_context_tree, op11_min_cut_text, op12_periodic_runs,
           op13_pair_maxscore]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
