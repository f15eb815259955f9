"""Incremental load: micro-batches, a ledger, resume, and recorded failure.

Every micro-batch owns one folder named by its batch id, in the target and in the ledger. A batch
that runs again after a lost executor or driver overwrites its own folder, so nothing is stored twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.functions.coerce import FieldSpec
from vecferry.operators.transform import REASON, transform_documents, with_key

LEDGER_SCHEMA = (
    "index_name string, n_accepted bigint, n_rejected bigint, first_key string, last_key string, at timestamp"
)
RUN_SCHEMA = "index_name string, status string, error string, at timestamp"


@dataclass(frozen=True)
class LoadPaths:
    """Where one load keeps its rows, ledger and stream checkpoint. A new generation starts over."""

    root: str
    generation: int = 0

    def _below(self, name: str) -> str:
        return f"{self.root}/generation-{self.generation}/{name}"

    @property
    def rows(self) -> str:
        return self._below("rows")

    @property
    def ledger(self) -> str:
        return self._below("ledger")

    @property
    def runs(self) -> str:
        return self._below("runs")

    @property
    def checkpoint(self) -> str:
        return self._below("checkpoint")

    def start_over(self) -> LoadPaths:
        return LoadPaths(self.root, self.generation + 1)


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", files_per_batch: int = 1_000
) -> DataFrame:
    """New files of a folder as a stream, with a declared schema."""
    return spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch).load(path)


def _note_run(spark: SparkSession, paths: LoadPaths, index_name: str, status: str, error: str | None = None) -> None:
    note = spark.range(1).select(
        F.lit(index_name).alias("index_name"), F.lit(status).alias("status"),
        F.lit(error).cast("string").alias("error"), F.current_timestamp().alias("at"),
    )
    note.write.mode("append").parquet(paths.runs)


def _write_batch(transformed: DataFrame, batch_id: int, paths: LoadPaths, index_name: str, key: str) -> int:
    """Rows first, ledger second: a ledger row exists only for a batch whose rows are complete. Returns the rows accepted."""
    spark = transformed.sparkSession
    good = F.col(REASON).isNull()
    seen = Observation(f"batch-{batch_id}")
    (
        transformed.withColumn("outcome", F.when(good, "accepted").otherwise("rejected"))
        .observe(
            seen, F.count_if(good).alias("n_accepted"), F.count_if(~good).alias("n_rejected"),
            F.min(F.when(good, F.col(key))).cast("string").alias("first_key"),
            F.max(F.when(good, F.col(key))).cast("string").alias("last_key"),
        )
        .write.mode("overwrite").partitionBy("outcome").parquet(f"{paths.rows}/batch_id={batch_id}")
    )
    counted = seen.get
    entry = spark.range(1).select(
        F.lit(index_name).alias("index_name"),
        *[F.lit(counted[c]).cast("bigint").alias(c) for c in ("n_accepted", "n_rejected")],
        *[F.lit(counted[c]).cast("string").alias(c) for c in ("first_key", "last_key")],
        F.current_timestamp().alias("at"),
    )
    entry.write.mode("overwrite").parquet(f"{paths.ledger}/batch_id={batch_id}")
    return counted["n_accepted"]


def stream_load(
    documents: DataFrame, specs: list[FieldSpec], paths: LoadPaths, index_name: str,
    on_progress: Callable[[int, int], None] | None = None, total: int = 0, defaults: bool = True,
) -> None:
    """Loads everything that has arrived, then stops; run again to continue where it stopped.

    On failure the run is recorded with its message and the error is raised again. Documents of an index without a key
    get a generated one, a digest of the row. The ledger is read once for a run; later batches add to its total.
    """
    spark = documents.sparkSession
    documents, specs = with_key(documents, specs)
    key = next(s.target for s in specs if s.is_key)
    done: list[int] = []
    transformed = transform_documents(documents, specs, defaults)

    def batch(rows: DataFrame, batch_id: int) -> None:
        accepted = _write_batch(rows, batch_id, paths, index_name, key)
        if on_progress:
            if not done:
                before = read_ledger(rows.sparkSession, paths).filter(F.col("batch_id") < batch_id)
                done.append(before.agg(F.sum("n_accepted").alias("n")).first().n or 0)
            done[0] += accepted
            on_progress(done[0], total)

    _note_run(spark, paths, index_name, "in_progress")
    try:
        query = (
            transformed.writeStream.foreachBatch(batch)
            .option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    except Exception as error:
        _note_run(spark, paths, index_name, "failed", str(error))
        raise
    _note_run(spark, paths, index_name, "completed")


def read_rows(spark: SparkSession, paths: LoadPaths, outcome: str = "accepted") -> DataFrame:
    rows = spark.read.parquet(paths.rows).filter(F.col("outcome") == outcome).drop("outcome", "batch_id")
    return rows.drop(REASON) if outcome == "accepted" else rows


def read_ledger(spark: SparkSession, paths: LoadPaths) -> DataFrame:
    schema = T.StructType([*T.StructType.fromDDL(LEDGER_SCHEMA).fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(paths.ledger)


def read_runs(spark: SparkSession, paths: LoadPaths) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(paths.runs)


def progress(spark: SparkSession, paths: LoadPaths, total: DataFrame) -> DataFrame:
    """Latest state of a load; ``total`` is the source count as a one-row table."""
    state = read_runs(spark, paths).groupBy("index_name").agg(
        F.max_by("status", "at").alias("status"), F.max_by("error", "at").alias("error")
    )
    done = read_ledger(spark, paths).groupBy("index_name").agg(
        F.sum("n_accepted").alias("migrated"), F.sum("n_rejected").alias("rejected"), F.max("batch_id").alias("last_batch"),
        F.max_by("last_key", "batch_id").alias("last_key"),
    )
    joined = state.join(done, "index_name", "left").fillna(0, ["migrated", "rejected"])
    counted = joined.withColumn("total", F.coalesce(total.scalar(), F.lit(0)))
    pct = F.coalesce(F.try_divide(F.col("migrated") * 100, F.col("total")), F.lit(0.0))
    return counted.withColumn("progress_pct", F.round(pct, 4))
