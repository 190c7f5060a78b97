"""From raw documents to packed sequences: each stage keeps, changes or repeats documents, the last one packs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from motionweave.llm import mixing, neardup, packing, quality, secrets
from motionweave.llm.common import table
from motionweave.session import cut_lineage


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.one_of_each(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    clean = secrets.redact(F.col("text"), F.col("secrets"))
    found = secrets.scan(docs, secrets.train(docs))
    return found.withColumn("text", clean).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    mixed = mixing.mix(docs)
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2)))).where("copy <= mix.copies").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, by training sequence."""
    return packing.pack(docs, with_ids=False).drop("ids")


STAGES = [
    ("quality_rules", drop_poor), ("near_duplicates", drop_copies), ("secret_scan", hide_secrets), ("mix_sources", mix_sources),
    ("packing", pack_sequences),
]

# Weighted signatures, Markov models and a subword tokenizer are beyond SQL; tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
