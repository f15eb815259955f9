"""Loading of the given tables, with the columns a query names and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SMALL_SCAN = 64  # scan partitions; with the default split size at most 8 GB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """A small plain scan over all cores by its unique key, ahead of work that is heavy per row.

    Larger scans have partitions enough and stay as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    partitions = scan.rdd.getNumPartitions()
    return scan.repartition(cores, key) if partitions < min(cores, SMALL_SCAN) else scan
