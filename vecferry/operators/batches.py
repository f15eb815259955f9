"""Consecutive numbering of rows in key order, without one window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecferry.session import work_path

RANK = "_rn"
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row's place inside its partition here


def number_rows(df: DataFrame, order: list[Column], partitions: int | None = None, path: str | None = None) -> DataFrame:
    """Adds ``_rn``, 1..n in the given order, which must be total (end it with a unique key).

    One range shuffle sorts the rows. The sorted rows are written once to the shared folder, because
    range boundaries are sampled anew whenever a plan runs; the written copy fixes them. A row's
    number is then its place in its partition plus the size of all partitions before it.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = path or work_path(spark, "numbered")
    (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _LOCAL_BITS))
        .write.parquet(target)
    )
    stored = spark.read.parquet(target)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # at most `parts` rows
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(RANK, F.col("_offset") + local + 1)
        .drop("_place", "_part", "_offset")
    )


def batch_of(size: int, rank: str = RANK) -> Column:
    """Number (from 0) of the fixed-size batch a numbered row falls in."""
    return F.floor((F.col(rank) - 1) / size).cast("long")


def skip_rows(numbered: DataFrame, skip: int) -> DataFrame:
    """Everything after the first ``skip`` rows, with no upper bound on ``skip``."""
    return numbered.filter(F.col(RANK) > skip)


def batch_stats(numbered: DataFrame, size: int, key: str) -> DataFrame:
    """Rows, last key and rows migrated so far for every batch.

    The running total needs no window: it is the highest row number in the batch.
    """
    return numbered.groupBy(batch_of(size).alias("batch")).agg(
        F.count("*").alias("n_rows"),
        F.max_by(F.col(key), F.col(RANK)).alias("last_key"),
        F.max(RANK).alias("migrated"),
    )


def running_sums(df: DataFrame, position: str, values: list[str], width: int = 10_000) -> DataFrame:
    """Running totals over dense positions 0, 1, 2 ... by blocks of ``width`` rows and groups of ``width`` blocks.

    Windows run inside a block and inside a group of blocks; the one over all groups has a row per ``width ** 2`` rows.
    """
    blocked = df.withColumn("_block", F.floor(F.col(position) / width).cast("long"))

    def before(*partition: str) -> Window:
        spec = Window.partitionBy(*partition) if partition else Window
        return spec.orderBy("_group" if not partition else "_block").rowsBetween(Window.unboundedPreceding, -1)

    per_block = blocked.groupBy("_block").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    per_block = per_block.withColumn("_group", F.floor(F.col("_block") / width).cast("long"))
    per_group = per_block.groupBy("_group").agg(*[F.sum(f"_{v}").alias(f"_{v}") for v in values])
    groups = per_group.select("_group", *[F.coalesce(F.sum(f"_{v}").over(before()), F.lit(0)).alias(f"_g_{v}") for v in values])
    blocks = per_block.select("_group", "_block", *[F.coalesce(F.sum(f"_{v}").over(before("_group")), F.lit(0)).alias(f"_b_{v}") for v in values])
    offsets = blocks.join(groups, "_group").select("_block", *[(F.col(f"_b_{v}") + F.col(f"_g_{v}")).alias(f"_{v}") for v in values])
    inside = Window.partitionBy("_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.join(offsets, "_block")
    for v in values:
        summed = summed.withColumn(f"running_{v}", F.sum(v).over(inside) + F.col(f"_{v}"))
    return summed.drop("_block", *[f"_{v}" for v in values])
