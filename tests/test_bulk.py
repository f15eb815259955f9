import datetime
import json
import subprocess
import sys
import textwrap
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vecferry.sources import bulk

ROOT = Path(__file__).resolve().parent.parent
KINDS = "id long, name string, v array<float>, packed binary, ok boolean, at timestamp, day date, price decimal(9,2), part struct<a:int,b:array<binary>>"


def rows(spark, n=25):
    made = [(
        i, None if i % 5 == 0 else f"näme {i}\n\"q\"", [i / 3, None, -1.5], bytes([i, 255]), i % 2 == 0, datetime.datetime(2024, 1, 2, 3, 4, 5, i),
        datetime.date(2024, 1, 1 + i), Decimal(f"{i}.25"), (i, [b"", None, b"\x00\xff"])) for i in range(n)]
    return spark.createDataFrame(made, KINDS)


@pytest.mark.parametrize("kind", bulk.FORMATS)
def test_rows_come_back_and_files_keep_their_bounds(spark, tmp_path, kind):
    frame, path = rows(spark).repartition(2, "id"), str(tmp_path / "out")
    bulk.export(frame, path, file_format=kind, max_rows=4)
    bulk.export(frame.withColumn("id", F.col("id") + 100), path, file_format=kind, max_rows=1000)
    got = bulk.read(spark, path)
    assert got.schema.simpleString() == frame.schema.simpleString()
    wanted = frame.unionByName(frame.withColumn("id", F.col("id") + 100))
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(wanted.collect(), key=lambda r: r.id)
    first, second = bulk.manifests(path)
    assert first["rows"] == 25 and max(f["rows"] for f in first["files"]) == 4 and len(second["files"]) == 2
    on_disk = {p.name for p in (tmp_path / "out/rows" / first["write"]).iterdir() if not p.name.startswith(".")}
    assert on_disk == {f["name"] for f in first["files"]}


@pytest.mark.parametrize("kind", bulk.FORMATS)
def test_files_are_bounded_in_bytes(spark, tmp_path, kind):
    frame, path = spark.range(2000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1), str(tmp_path / "out")
    bulk.export(frame, path, file_format=kind, max_bytes=20_000)
    files = bulk.manifests(path)[0]["files"]
    assert len(files) > 3 and all(0 < f["bytes"] <= 20_000 for f in files)
    assert all((tmp_path / "out/rows" / bulk.manifests(path)[0]["write"] / f["name"]).stat().st_size == f["bytes"] for f in files)
    assert bulk.read(spark, path).agg(F.sum("id"), F.count_distinct("text")).first()[:] == (1999000, 2000)
    with pytest.raises(Exception, match="does not fit"):
        bulk.export(spark.range(1).select(F.repeat(F.lit("é"), 20_000).alias("x")), path, max_bytes=10_000)
    assert len(bulk.manifests(path)) == 1


def test_overwrite_replaces_and_an_empty_table_has_a_schema(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="no rows have been written"):
        bulk.read(spark, path)
    bulk.export(spark.range(10), path)
    bulk.export(spark.range(5), path, mode="overwrite")
    assert sorted(r.id for r in bulk.read(spark, path).collect()) == list(range(5))
    assert len(list((tmp_path / "out/rows").iterdir())) == len(list((tmp_path / "out/manifests").glob("[!.]*.json"))) == 1
    bulk.export(spark.range(0), path, mode="overwrite")
    assert bulk.read(spark, path).collect() == [] and bulk.read(spark, path).columns == ["id"]


def test_a_write_that_fails_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    bulk.export(spark.range(3), path)
    bad = spark.range(1000, numPartitions=3).select(F.when(F.col("id") == 999, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="bad row"):
        bulk.export(bad, path, max_rows=10)
    assert sorted(r.id for r in bulk.read(spark, path).collect()) == [0, 1, 2]
    assert len(list((tmp_path / "out/rows").iterdir())) == 1


def test_a_damaged_file_is_noticed(spark, tmp_path):
    path = str(tmp_path / "out")
    bulk.export(spark.range(3).coalesce(1), path)
    file = next((tmp_path / "out/rows").glob("*/*.json"))
    file.write_bytes(file.read_bytes()[:-4])
    with pytest.raises(Exception, match="not what was written"):
        bulk.read(spark, path).collect()


def test_a_task_that_fails_once_doubles_no_row(tmp_path):
    """In a session of its own, whose tasks may fail once: the first attempt of a task stops after it has written files."""
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        from pyspark.sql import SparkSession
        from vecferry.sources import bulk
        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.execution.arrow.maxRecordsPerBatch", "50").getOrCreate()

        def once(batches):
            from pyspark import TaskContext
            for number, batch in enumerate(batches):
                if TaskContext.get().attemptNumber() == 0 and number == 6:
                    raise RuntimeError("lost")
                yield batch

        rows = spark.range(1000, numPartitions=2).mapInArrow(once, "id long")
        bulk.export(rows, {str(tmp_path / "out")!r}, max_rows=20)
        print(sorted(r.id for r in bulk.read(spark, {str(tmp_path / "out")!r}).collect()) == list(range(1000)))
    """)
    run = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, cwd=tmp_path, timeout=300)
    assert run.stdout.strip() == "True", run.stderr[-2000:]
    manifest = json.loads(next((tmp_path / "out/manifests").glob("[!.]*.json")).read_text())
    left = {p.name for p in (tmp_path / "out/rows").glob("*/*") if not p.name.startswith(".")}
    assert left == {f["name"] for f in manifest["files"]} and manifest["rows"] == 1000
