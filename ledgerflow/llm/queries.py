"""The registered queries of this subpackage: each applies an operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (
    alignment, bit_planes, ctw, fingerprints, lsh_forest, mixing, packing, rank_queue, secret_ledger, substrings, tokens,
    toxicity, wand,
)
from ledgerflow.llm.oracles import ORACLE
from ledgerflow.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = _table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, f"secret-ledger-{uuid4().hex}")
    # About half of the documents had arrived before; then the whole table comes, of which only blobs not seen are scanned.
    earlier = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    secret_ledger.scan_blobs(docs.where(earlier), ledger)
    found = secret_ledger.scan(docs, ledger)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = secret_ledger.digest(F.col("secrets"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, repeats=2.0, keep_text=False)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lsh_forest.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return joined.select("doc_id", "class_id", "n_links")


def op7_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return wand.search(docs, docs.where(F.col("doc_id") % 100 == 0), k=10)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), size=1024, end_id=2)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbour_report(_table(spark, sf_dir, "documents"))


def op10_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(_table(spark, sf_dir, "documents"))


def _small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows that go to a Python worker at a time: the default of 10,000 whole texts makes buffers of tens of MB in every task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def op11_rank_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    coded = rank_queue.round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select(
        "doc_id", rank_queue.n_ids("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return alignment.report(_table(spark, sf_dir, "documents"))


def op13_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bit_planes.cluster(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, salt="2")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", bit_planes.centroid_digest().alias("centroid_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_secret_ledger, op2_token_counts, op3_toxicity, op4_mixing, op5_substring_dedup, op6_ngram_jaccard,
        op7_bm25_wand, op8_packing, op9_fingerprints, op10_context_tree,
        op11_rank_queue, op12_alignment, op13_bit_planes)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
