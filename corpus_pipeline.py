"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before has kept, as a table read back from Parquet, and
returns the columns of `documents`; the last returns pieces with their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.llm import decontaminate, line_dedup, minhash, packing, quality
from forgepulse.llm.common import ship, stored, table
from forgepulse.session import prepare


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain rules and resemble the trusted ones."""
    ready(spark)
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    return quality.judged(docs, trusted).where("kept").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go; so does a document of which nothing is left."""
    ready(spark)
    cleaned = line_dedup.dedup_lines(docs, whole=True).where("size(runs) = 0 OR clean_text IS NOT NULL")
    text = F.col("clean_text")
    new = {"text": text, "n_chars": F.when(F.size("runs") > 0, F.length(text)).otherwise(F.col("n_chars"))}
    return cleaned.select(
        *(new[c].cast(kind).alias(c) if c in new else F.col(c) for c, kind in docs.dtypes)
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    ready(spark)
    return minhash.near_duplicates(docs).where("first").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    ready(spark)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hit_words") == 0).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: its document, tokens, sequence and place there."""
    ready(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

# MinHash components and best-fit packing have no SQL form; tests hold the stages
# against brute force.
ORACLE_SQL = None


def ready(spark: SparkSession) -> None:
    ship(prepare(spark))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
