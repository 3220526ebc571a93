"""The corpus pipeline: documents in, packed training bins out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of documents, whatever further columns there are. Empty documents, labels or
benchmarks give empty or unchanged results; repeated rows are treated each by itself but for the
near duplicates, of which one row stays. Null and empty texts have the score of such training rows,
no near duplicates, no benchmark passages, no secrets, and are pieces of no words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import decontaminate, near_dedup, packing, quality_crf, secret_scan
from sightline.llm.cluster import cut


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier scores 0.7 or more. It learns from the labels that op1 learns from, so that the held-out quarter measures it too."""
    learn_from = ~F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return quality_crf.keep_good(docs, quality_crf.fit(docs, _table(spark, sf_dir, "labels"), learn_from=learn_from))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest id."""
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets masked and n_chars, where there is one, counted anew (null for a null text)."""
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their bins."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packed),
]

#: SQL can't express the classifier, signatures and packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each on a checkpoint of the one before."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
