"""A log of changes, and ingest that is safe against repeated delivery.

Rows of a batch go below a folder named by its id, so a batch that runs again overwrites its own output. ``table`` has the
change feed that is kept as a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.sources.target import balanced, folder_exists

BUCKET = "_bucket"


def latest_changes(changes: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """Last change of every key. A maximum combines on the map side, so a busy key costs one row per task."""
    values = [c for c in changes.columns if c not in keys]
    order = F.struct(*sequence)
    row = F.struct(order.alias("_order"), *[F.col(c) for c in values if c not in sequence])
    last = changes.groupBy(*keys).agg(F.max_by(row, order).alias("_r"))
    return last.select(*keys, *[
        F.col(f"_r._order.{c}" if c in sequence else f"_r.{c}").alias(c) for c in values
    ])


def run_batches(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def apply_changes(stream: DataFrame, log_path: str, checkpoint: str, keys: list[str], sequence: list[str]) -> None:
    """Appends the last change per key of every micro-batch to a log.

    A repeated batch overwrites its own folder, and the state below is a maximum, so replay changes nothing.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        latest_changes(rows, keys, sequence).write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    run_batches(stream, batch, checkpoint)


def current_state(
    spark: SparkSession, log_path: str, keys: list[str], sequence: list[str], is_delete: Column, snapshot_path: str | None = None
) -> DataFrame:
    """The table after all logged changes; with a snapshot, after it and the batches logged since."""
    logged = spark.read.parquet(log_path)
    if snapshot_path:
        snapshot = spark.read.parquet(snapshot_path)
        last = snapshot.agg(F.max("_last_batch").alias("n")).scalar()
        logged = logged.filter(F.col("batch_id") > F.coalesce(last, F.lit(-1))).drop("batch_id").unionByName(snapshot.drop("_last_batch"))
    else:
        logged = logged.drop("batch_id")
    return latest_changes(logged, keys, sequence).filter(~is_delete)


def compact(spark: SparkSession, log_path: str, snapshot_path: str, keys: list[str], sequence: list[str]) -> None:
    """Last change per key of all batches so far as a snapshot; deletes are kept, late changes may still arrive.

    The snapshot remembers the last batch it has, so that the log's later batches are read with it.
    """
    logged = spark.read.parquet(log_path)
    last = logged.agg(F.max("batch_id").alias("n")).first().n
    latest = latest_changes(logged.filter(F.col("batch_id") <= last).drop("batch_id"), keys, sequence)
    latest.withColumn("_last_batch", F.lit(last).cast("long")).write.parquet(snapshot_path)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def deduplicated(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """First delivery of every key, with state bounded by the delay: it holds the keys of that span of event time.

    Rows later than the delay are dropped by the watermark; where those must survive use ``append_new``.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def first_of_each(rows: DataFrame, key: str, sequence: list[str]) -> DataFrame:
    """The row of each key that is first by ``sequence``, and among equals the one of least digest: the same in every run."""
    others = [c for c in rows.columns if c != key]
    row = F.struct(*others)
    first = rows.groupBy(key).agg(F.min_by(row, F.struct(*sequence, F.xxhash64(*others))).alias("_r"))
    return first.select(key, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*rows.columns)


def append_new(stream: DataFrame, path: str, checkpoint: str, key: str, sequence: list[str] | None = None, buckets: int = 64) -> None:
    """Exact for rows of any age: each batch keeps the keys that the batches before it did not store.

    Of several rows with a key in one batch the first by ``sequence`` is kept. Only the key column of the buckets that
    the batch falls in is read. ``stored_rows`` reads the table.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        fresh = (first_of_each(rows, key, sequence or []) if len(rows.columns) > 1 else rows.distinct()).withColumn(BUCKET, _bucket([key], buckets))
        if folder_exists(spark, path):
            touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
            schema = T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField(BUCKET, T.IntegerType())])
            stored = spark.read.schema(schema).parquet(path).filter((F.col("batch_id") < batch_id) & F.col(BUCKET).isin(touched))
            fresh = fresh.join(stored.select(key), key, "left_anti")
        balanced(fresh, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/batch_id={batch_id}")

    run_batches(stream, batch, checkpoint)


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id", BUCKET)
