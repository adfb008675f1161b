"""The corpus pipeline: quality, exact copies, near copies, source mix, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import exact_dedup, mixing, near_dedup, pieces, quality_classifier
from pagewright.llm.common import documents
from pagewright.session import workspace


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_classifier.fit_quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.keep_good(docs, model)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text, the one with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return near_dedup.drop_near_copies(docs, width=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the source mix, a row per epoch."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids."""
    return pieces.encode_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact),
    ("near dedup", drop_near),
    ("source mix", mix_sources),
    ("sentencepiece", encode_pieces),
]
#: A trained classifier and piece ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        path = workspace(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
