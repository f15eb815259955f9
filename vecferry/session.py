"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, driver_memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vecferry")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else one below the warehouse, which executors share too."""
    configured = _configured_checkpoint_dir(spark)
    return configured.rstrip("/") if configured else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/vecferry-work"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever written twice to one."""
    return f"{work_root(spark)}/vecferry-{name}-{uuid.uuid4().hex}"


def written(table: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder: for what several later steps read, or costly work is behind."""
    path = work_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


def clear_work(spark: SparkSession) -> int:
    """Deletes the working files below the shared folder; returns how many folders went.

    Results that still read them become invalid, so this is for the end of a job.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_root(spark)}/vecferry-*")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(path) or []
    return sum(bool(system.delete(status.getPath(), True)) for status in found)
