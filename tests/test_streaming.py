import pytest
from pyspark.sql import functions as F

from vecferry.functions.coerce import FieldSpec
from vecferry.streaming import changes, load

SPECS = [FieldSpec("id", "id", "INT64", is_key=True), FieldSpec("n", "n", "INT32")]


def stage(spark, path, start, end, files=2):
    rows = spark.range(start, end).select(
        F.when(F.col("id") % 10 != 9, F.col("id")).alias("id"), (F.col("id") % 4).cast("string").alias("n"))
    rows.repartition(files).write.mode("append").parquet(path)
    return rows.schema


def run(spark, source, schema, paths, **options):
    load.stream_load(load.read_stream(spark, source, schema, files_per_batch=1), SPECS, paths, "items", **options)


def test_load_resume_and_progress(spark, tmp_path):
    source, paths = str(tmp_path / "in"), load.LoadPaths(str(tmp_path / "out"))
    schema = stage(spark, source, 0, 100)
    seen = []
    run(spark, source, schema, paths, on_progress=lambda done, total: seen.append((done, total)), total=100)
    assert [total for _, total in seen] == [100, 100] and seen[-1][0] == 90
    assert seen[0][0] < 90
    run(spark, source, schema, paths)
    assert load.read_rows(spark, paths).count() == 90
    stage(spark, source, 100, 150)
    run(spark, source, schema, paths)
    ids = [r.id for r in load.read_rows(spark, paths).collect()]
    assert sorted(ids) == [i for i in range(150) if i % 10 != 9]
    assert load.read_rows(spark, paths, "rejected").count() == 15
    state = load.progress(spark, paths, spark.range(150).agg(F.count("*").alias("n"))).first()
    assert (state.status, state.migrated, state.rejected, state.progress_pct) == ("completed", 135, 15, 90.0)
    assert state.last_batch == 3


def test_a_repeated_batch_stores_nothing_twice(spark, tmp_path):
    paths = load.LoadPaths(str(tmp_path))
    from vecferry.operators.transform import transform_documents

    rows = transform_documents(spark.range(10).select("id", F.lit("1").alias("n")), SPECS)
    for _ in range(2):
        load._write_batch(rows, 0, paths, "items", "id")
    assert load.read_rows(spark, paths).count() == 10
    assert [r.n_accepted for r in load.read_ledger(spark, paths).collect()] == [10]


def test_failure_is_recorded_and_raised_and_the_load_continues(spark, tmp_path):
    source, paths = str(tmp_path / "in"), load.LoadPaths(str(tmp_path / "out"))
    schema = stage(spark, source, 0, 40)
    calls = []

    def stop_after_one(done, total):
        calls.append(done)
        if len(calls) == 1:
            raise RuntimeError("stopped on purpose")

    with pytest.raises(Exception):
        run(spark, source, schema, paths, on_progress=stop_after_one)
    runs = {r.status: r.error for r in load.read_runs(spark, paths).collect()}
    assert "stopped on purpose" in runs["failed"]
    run(spark, source, schema, paths)
    ids = [r.id for r in load.read_rows(spark, paths).collect()]
    assert sorted(ids) == [i for i in range(40) if i % 10 != 9]


def test_start_over_loads_everything_again_elsewhere(spark, tmp_path):
    source, paths = str(tmp_path / "in"), load.LoadPaths(str(tmp_path / "out"))
    schema = stage(spark, source, 0, 20)
    run(spark, source, schema, paths)
    fresh = paths.start_over()
    run(spark, source, schema, fresh)
    assert load.read_rows(spark, fresh).count() == load.read_rows(spark, paths).count() == 18


def test_stream_equals_batch(spark, tmp_path):
    from vecferry.operators.transform import accepted, transform_documents

    source, paths = str(tmp_path / "in"), load.LoadPaths(str(tmp_path / "out"))
    schema = stage(spark, source, 0, 200, files=5)
    run(spark, source, schema, paths)
    batch = accepted(transform_documents(spark.read.parquet(source), SPECS))
    assert sorted(load.read_rows(spark, paths).collect()) == sorted(batch.collect())


CHANGES = "k int, seq int, op string, v string"


def apply(spark, tmp_path, *feeds):
    log = str(tmp_path / "log")
    for feed in feeds:
        spark.createDataFrame(feed, CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
        stream = load.read_stream(spark, str(tmp_path / "feed"), spark.createDataFrame([], CHANGES).schema)
        changes.apply_changes(stream, log, str(tmp_path / "cp"), ["k"], ["seq"])
    return log


def test_changes_upsert_delete_and_late_arrival(spark, tmp_path):
    log = apply(
        spark, tmp_path,
        [(1, 1, "put", "a"), (2, 2, "put", "b"), (1, 3, "put", "c")],
        [(2, 5, "del", None), (3, 6, "put", "d"), (1, 2, "put", "late")],
    )
    state = changes.current_state(spark, log, ["k"], ["seq"], F.col("op") == "del")
    assert {r.k: r.v for r in state.collect()} == {1: "c", 3: "d"}
    snapshot = str(tmp_path / "snapshot")
    changes.compact(spark, log, snapshot, ["k"], ["seq"])
    deleted = F.col("op") == "del"
    again = changes.current_state(spark, log, ["k"], ["seq"], deleted, snapshot)
    assert sorted(again.collect()) == sorted(state.collect())
    apply(spark, tmp_path, [(1, 9, "del", None), (2, 4, "put", "too late"), (4, 1, "put", "new")])
    after = changes.current_state(spark, log, ["k"], ["seq"], deleted, snapshot)
    assert {r.k: r.v for r in after.collect()} == {3: "d", 4: "new"}
    assert sorted(after.collect()) == sorted(changes.current_state(spark, log, ["k"], ["seq"], deleted).collect())


def test_first_of_each_is_the_same_in_every_run(spark):
    rows = [(1, 5, "x"), (1, 2, "y"), (1, 2, "z"), (2, 1, "w")]
    found = {tuple(sorted(map(tuple, changes.first_of_each(spark.createDataFrame(rows[::d], "k int, s int, v string").repartition(n), "k", ["s"]).collect())))
             for d in (1, -1) for n in (1, 3)}
    assert len(found) == 1 and {r[1] for r in found.pop()} == {2, 1}


def test_a_load_without_a_key_gets_one(spark, tmp_path):
    source, paths = str(tmp_path / "in"), load.LoadPaths(str(tmp_path / "out"))
    schema = stage(spark, source, 0, 20)
    keyless = [FieldSpec("id", "id", "INT64"), FieldSpec("n", "n", "INT32")]
    load.stream_load(load.read_stream(spark, source, schema), keyless, paths, "items")
    rows = load.read_rows(spark, paths)
    assert rows.count() == 20 and "_generated_id" in rows.columns


def test_null_values_of_the_last_change_win(spark, tmp_path):
    log = apply(spark, tmp_path, [(1, 1, "put", "a"), (1, 2, "put", None)])
    row = changes.current_state(spark, log, ["k"], ["seq"], F.col("op") == "del").first()
    assert (row.k, row.seq, row.v) == (1, 2, None)


def test_append_new_keeps_every_key_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for start in (0, 50, 25):
        spark.range(start, start + 60).coalesce(1).write.mode("append").parquet(source)
        stream = load.read_stream(spark, source, spark.range(0).schema)
        changes.append_new(stream, out, str(tmp_path / "cp"), "id")
    assert sorted(r.id for r in changes.stored_rows(spark, out).collect()) == list(range(110))
