"""Reading exported documents: fixed schema, all rows, only the named columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.operators.transform import strip_metadata

FORMATS = ("parquet", "json")


def scan(
    spark: SparkSession, path: str, select: list[str] | None = None, schema: T.StructType | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """All documents of an export, without response metadata. JSON needs a declared schema."""
    if file_format not in FORMATS:
        raise ValueError(f"unknown format {file_format}, expected one of {FORMATS}")
    if file_format == "json" and schema is None:
        raise ValueError("a JSON export needs a declared schema")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    documents = strip_metadata(reader.format(file_format).load(path))
    return documents.select(*select) if select else documents


def count_documents(documents: DataFrame) -> DataFrame:
    return documents.agg(F.count("*").alias("n_documents"))


def ordered_by_key(documents: DataFrame, key: str) -> DataFrame:
    """Key order for output; a range shuffle, each partition sorted."""
    return documents.orderBy(F.col(key).asc())


def sample(documents: DataFrame, key: str, limit: int = 5) -> DataFrame:
    """First documents in key order."""
    return documents.orderBy(key).limit(limit)


def table_stats(documents: DataFrame, key: str, text: str) -> DataFrame:
    return documents.agg(
        F.count("*").alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"),
        F.sum(F.octet_length(text).cast("long")).alias("text_bytes"),
    )


def payload_megabytes(documents: DataFrame) -> DataFrame:
    """Size of the documents as UTF-8 JSON."""
    size = F.octet_length(F.to_json(F.struct(*documents.columns), {"ignoreNullFields": "false"})).cast("long")
    return documents.agg(F.sum(size).alias("n_bytes")).withColumn("megabytes", F.col("n_bytes") / (1024 * 1024))
