"""The corpus pipeline: five stages, each reading what the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.llm import decontaminate, line_dedup, queries, similar, toxicity
from veriframe.sources.workspace import work_dir


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose score is below the threshold, by a model of the labelled rows outside the held-out fold."""
    name = "_toxicity"
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    scored = toxicity.score(docs, queries.toxic_model(spark, folder), out=name)
    return scored.where(F.col(name) < toxicity.THRESHOLD).drop(name)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without lines that earlier lines repeat; n_chars counts what is left."""
    left = line_dedup.dedup_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in left.columns else left


def without_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates, by SimHash and min-hashes: five-word shingles, a similarity of 0.8 or more."""
    return similar.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminated(docs, queries.table(spark, folder, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return queries.bpe_digests(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("byte_bpe", encoded),
]

#: A trained model and hashed fingerprints decide; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order over documents, each written as Parquet and read again as the next one's input."""
    docs = queries.table(spark, folder, "documents")
    base = work_dir(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    for name, stage in STAGES:
        stage(spark, docs, folder).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
