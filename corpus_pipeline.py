"""A corpus pipeline of five stages over ``documents``.

toxicity      documents predicted toxic go
near_dup      one document of each class of near duplicates stays (texts without words all stay)
secrets       every secret found is replaced by a mark in the text
mix           sources are mixed to target weights; every document is kept, small sources are repeated
pack          texts are packed into sequences of 1024 tokens

Each stage works on all that its predecessor kept and returns the columns of
documents (the last one returns pieces).  A document that the mix takes twice
comes as two rows with the same id.  Texts are changed by ``secrets`` alone,
which also renews n_chars.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import lsh_forest, mixing, packing, secret_ledger, toxicity
from ledgerflow.session import scratch_path


#: Rows that go to a Python worker at a time.  The default of 10,000 texts makes buffers of tens of MB on both sides of every
#: task, which executors and workers keep from stage to stage.
ROWS_PER_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, labels).where("predicted = 0").select(docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return lsh_forest.one_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_ledger.redact(secret_ledger.scan(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, repeats=2.0, positions=False).select(docs.columns)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs, size=1024, end_id=2)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dup", near_dup_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

#: The classifier of the first stage is trained, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, f"pipeline-{uuid4().hex}")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
