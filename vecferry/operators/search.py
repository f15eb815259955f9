"""Exact vector search over a vector table (id, vector, scalar columns)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecferry.operators import batches
from vecferry.operators.scoring import Dense, matches
from vecferry.session import written


def mean_vectors(vectors: DataFrame, vector: str, by: str | None = None) -> DataFrame:
    """Mean vector of all rows, or one per value of ``by``; combined on the map side."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))).alias(vector)
    grouped = vectors.filter(F.col(vector).isNotNull())
    return grouped.groupBy(F.col(by).alias("query_id")).agg(mean) if by else grouped.agg(mean)


def knn(
    vectors: DataFrame, queries: DataFrame, k: int, metric: str = "COSINE", id_column: str = "id", vector: str = "vector",
    where: Column | None = None, output_fields: list[str] | None = None, group: str | None = None,
    broadcast: bool | None = None,
) -> DataFrame:
    """Best k per query (per query and group), brute force and so with full recall.

    ``where`` is applied before any score and reaches the scan.
    """
    items = vectors if where is None else vectors.filter(where)
    return matches(items, queries, Dense(metric, vector), id_column, output_fields, k, group, broadcast=broadcast)


def range_search(
    vectors: DataFrame, queries: DataFrame, low: float, high: float, metric: str = "L2", id_column: str = "id",
    vector: str = "vector", broadcast: bool | None = None,
) -> DataFrame:
    """All rows with low <= distance < high."""
    return matches(vectors, queries, Dense(metric, vector), id_column, band=(low, high), broadcast=broadcast)


def iterate(
    vectors: DataFrame, query: DataFrame, batch_size: int, metric: str = "COSINE", id_column: str = "id", vector: str = "vector"
) -> DataFrame:
    """The whole ordered result of one query, numbered in batches; no offset limit."""
    scorer = Dense(metric, vector)
    scored = written(matches(vectors, query, scorer, id_column), "scored")  # sorting samples first: score once
    order = [F.col("score").desc() if scorer.descending else F.col("score").asc(), F.col(id_column).asc()]
    numbered = batches.number_rows(scored, order)
    return numbered.select(id_column, "score", batches.batch_of(batch_size).alias("batch"))
