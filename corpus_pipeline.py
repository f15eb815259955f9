"""The corpus pipeline: quality rules, exact and near duplicates, mixing of sources, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vecferry.llm import exact, mixing, near, packing, quality
from vecferry.llm.common import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the model learns from the labelled ones among ``docs``."""
    return quality.keep_quality(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest ``doc_id`` stays."""
    return exact.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 of their five-word shingles the one with the smallest ``doc_id`` stays.

    Links come from SimHash fingerprints that meet by Golay keys and are verified; an exact join finds the links that
    fingerprints miss.
    """
    return near.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: a row per round, texts cut to the blocks taken where that is not all of them."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

# The stages train a classifier and use a tokenizer, which SQL cannot express; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written before the next one starts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
