"""Reciprocal rank fusion of ranked lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RRF_K = 60


def reciprocal_rank_fusion(lists: list[DataFrame], id_column: str, k: int, rrf_k: int = RRF_K) -> DataFrame:
    """Sum of 1 / (rrf_k + rank) over the lists (query_id, <id>, rank), best k per query.

    The lists are stacked and added up, which equals their full outer join and needs one shuffle.
    """
    parts = [r.select("query_id", id_column, (1.0 / (F.col("rank") + rrf_k)).alias("part")) for r in lists]
    stacked = reduce(DataFrame.unionByName, parts)
    fused = stacked.groupBy("query_id", id_column).agg(F.round(F.sum("part"), 9).alias("score"))
    window = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(id_column).asc())
    return fused.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
