"""Corpus pipeline: documents -> clean, good, distinct, redacted, packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes every stage's result as Parquet into the shared
checkpoint folder and reads it back as the next one's input, so a lost executor costs at
most the running stage; a stage's table is deleted when the next one is written.

Defined results: null and empty texts fail the quality rules and go, as does any document
that a stage rejects; texts of any length are read whole; of repeated rows one stays
(SimHash); ties go to the smallest id; an empty table gives no rows; further columns of
documents are carried to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import packing, quality, secret_scan, simhash, toxicity
from stratum.plans.versions import file_system
from stratum.session import ensure_checkpoint_dir
from stratum.sources.files import read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, rejects go."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the threshold table go."""
    return quality.keep_good(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are replaced in the texts; every document stays."""
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality rules", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("secret scans", secrets_stage),
    ("best-fit packing", packing_stage),
]

# the toxicity stage is a trained classifier, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4()}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            fs, path, _ = file_system(spark, f"{folder}/{k - 1}")
            fs.delete(path, True)
    return STAGES[-1][1](spark, docs, sf_dir)
