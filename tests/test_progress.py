from pyspark.sql import functions as F
from test_streaming import SPECS, stage

from vecferry.streaming import changes, load, progress


def test_progress_agrees_with_the_ledger(spark, tmp_path):
    source, paths, out = str(tmp_path / "in"), load.LoadPaths(str(tmp_path / "out")), str(tmp_path / "progress")
    schema = stage(spark, source, 0, 100, files=3)
    with progress.recorded(spark, out) as log:
        load.stream_load(load.read_stream(spark, source, schema, files_per_batch=1), SPECS, paths, "items")
    assert not log.running and not log.failed
    told = {r.batch_id: r.n_input_rows for r in progress.batches(spark.read.parquet(out)).collect()}
    assert told == {r.batch_id: r.n_accepted + r.n_rejected for r in load.read_ledger(spark, paths).collect()} and sum(told.values()) == 100
    load.stream_load(load.read_stream(spark, source, schema), SPECS, load.LoadPaths(str(tmp_path / "again")), "items")  # no longer recorded
    assert progress.batches(spark.read.parquet(out)).count() == 3


def test_state_rows_and_watermark_are_told(spark, tmp_path):
    out = str(tmp_path / "progress")
    rows = spark.range(40).select("id", F.timestamp_seconds(F.col("id") * 60).alias("at"))
    rows.repartition(2, "id").write.parquet(str(tmp_path / "in"))
    with progress.recorded(spark, out):
        stream = load.read_stream(spark, str(tmp_path / "in"), rows.schema, files_per_batch=1)
        query = changes.deduplicated(stream, "id", "at", "1 hour").writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    told = progress.batches(spark.read.parquet(out))
    assert told.agg(F.sum("n_input_rows")).first()[0] == 40
    assert told.agg(F.max("n_state_rows")).first()[0] > 0 and told.filter("watermark is not null").count() > 0


def test_a_failure_is_noted(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "in"))
    stream = load.read_stream(spark, str(tmp_path / "in"), spark.range(0).schema)

    def fail(rows, number):
        raise RuntimeError("stopped on purpose")

    with progress.recorded(spark, str(tmp_path / "progress")) as log:
        try:
            changes.run_batches(stream, fail, str(tmp_path / "cp"))
        except Exception as error:  # noqa: BLE001
            assert "stopped on purpose" in str(error)
    assert len(log.failed) == 1 and "stopped on purpose" in next(iter(log.failed.values()))
