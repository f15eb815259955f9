import pytest
from fixtures import RECIPES, write_definitions
from pyspark.sql import functions as F

from vecferry import session
from vecferry.functions.coerce import FieldSpec
from vecferry.operators import transform as tr
from vecferry.sources import definitions as de
from vecferry.sources import documents as src
from vecferry.sources import generator
from vecferry.sources import target as tg

SPECS = [FieldSpec("id", "id", "INT64", is_key=True), FieldSpec("t", "t", "VARCHAR", max_length=9)]


def test_create_keeps_an_existing_table_unless_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tg.target_exists(spark, path)
    assert tg.create_target(spark, path, SPECS)
    assert spark.read.parquet(path).schema["t"].metadata["max_length"] == 9
    rows = spark.range(5).select("id", F.lit("x").alias("t"))
    assert tg.append(rows, path) == 5
    assert tg.append(rows, path) == 5
    assert not tg.create_target(spark, path, SPECS)
    assert spark.read.parquet(path).count() == 10
    assert tg.create_target(spark, path, SPECS, drop_existing=True)
    assert spark.read.parquet(path).count() == 0


def test_outcomes_in_one_pass(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "id long, t string")
    counted = tg.write_outcomes(tr.transform_documents(rows, SPECS), str(tmp_path / "o"))
    assert counted == {"accepted": 2, "rejected": 1}
    assert sorted(r.id for r in tg.read_outcome(spark, str(tmp_path / "o"), "accepted").collect()) == [1, 3]
    assert tg.read_outcome(spark, str(tmp_path / "o"), "rejected").first()[tr.REASON] == "missing key id"


def test_partition_layout_prunes_and_keeps_all_rows(spark, tmp_path):
    rows = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("t"))
    path = str(tmp_path / "p")
    layout = tg.write_partitioned(rows, path, SPECS[1], buckets=4)
    stored = spark.read.parquet(path)
    assert stored.count() == 900
    one = stored.filter((F.col(layout) == tg.hash_bucket(F.lit("big"), 4)) & (F.col("t") == "big"))
    assert one.count() == 300
    assert "PartitionFilters: [isnotnull(t_bucket" in one._jdf.queryExecution().toString()


def test_layout_leaves_sizes_to_spark(spark):
    plan = tg.balanced(spark.range(10).withColumn("t", F.hex("id")), "t")._jdf.queryExecution().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "hashpartitioning(t" in plan


def test_small_scans_are_spread_and_large_ones_left_alone(spark):
    from vecferry.plans.tables import spread

    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert spread(small, "doc_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 70)
    assert spread(many, "id").rdd.getNumPartitions() == 70


def test_other_key_types_are_written_plainly(spark, tmp_path):
    key = FieldSpec("tags", "tags", "ARRAY", element_type="VARCHAR")
    rows = spark.range(3).select("id", F.array(F.lit("a")).alias("tags"))
    assert tg.write_partitioned(rows, str(tmp_path / "p"), key) is None
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_definitions_from_files_and_lines(spark, tmp_path):
    loaded = de.load_definitions(spark, write_definitions(tmp_path, RECIPES))
    fields = de.definition_fields(loaded)
    de.write_definitions(fields, str(tmp_path / "lines"))
    again = de.definition_fields(de.load_definitions(spark, str(tmp_path / "lines"), multi_line=False))
    assert sorted(map(tuple, fields.collect())) == sorted(map(tuple, again.collect()))
    assert de.definition_profiles(loaded).first().algorithm_name == "by-flavour"


def test_scan_needs_a_schema_for_json(spark, tmp_path):
    spark.range(3).withColumn("@meta", F.lit(1)).write.json(str(tmp_path / "j"))
    with pytest.raises(ValueError):
        src.scan(spark, str(tmp_path / "j"), file_format="json")
    with pytest.raises(ValueError):
        src.scan(spark, str(tmp_path / "j"), file_format="csv")
    schema = spark.createDataFrame([], "id long, `@meta` int").schema
    assert src.scan(spark, str(tmp_path / "j"), None, schema, "json").columns == ["id"]


def test_projection_reaches_the_scan(spark):
    df = src.scan(spark, "/root/testdata/sf0.001/documents.parquet", ["doc_id", "lang"])
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in df._jdf.queryExecution().toString()


def test_a_path_in_use_is_not_overwritten(spark, tmp_path):
    path = tmp_path / "busy"
    (path / "_temporary").mkdir(parents=True)  # a first load under way: nothing can be read yet
    assert tg.target_exists(spark, str(path))
    assert not tg.create_target(spark, str(path), SPECS)
    assert (path / "_temporary").exists()


def test_generated_readings(spark):
    rows = generator.sensor_readings(spark, 200).collect()
    assert len({r.reading for r in rows}) == 200
    assert all(abs(sum(x * x for x in r.signature) - 1) < 1e-3 and len(r.signature) == generator.VECTOR_DIM for r in rows)
    assert all(set(r.flags) <= set(generator.FLAGS) and -30 <= r.level <= 50 for r in rows)
    assert rows == generator.sensor_readings(spark, 200).collect()
    assert rows != generator.sensor_readings(spark, 200, seed=1).collect()
    assert 0 < sum(r.manual for r in rows) < 100


def test_generated_readings_load_without_rejects(spark, tmp_path):
    specs = [
        FieldSpec("reading", "id", "VARCHAR", max_length=64, is_key=True), FieldSpec("level", "level", "DOUBLE"),
        FieldSpec("flags", "flags", "ARRAY", element_type="VARCHAR"), FieldSpec("device", "device", "JSON"),
        FieldSpec("taken_at", "taken_at", "VARCHAR", max_length=64),
        FieldSpec("signature", "vector", "FLOAT_VECTOR", dim=generator.VECTOR_DIM),
    ]
    out = tr.transform_documents(generator.sensor_readings(spark, 100), specs)
    assert tg.write_outcomes(out, str(tmp_path / "o")) == {"accepted": 100, "rejected": 0}
    row = tg.read_outcome(spark, str(tmp_path / "o"), "accepted").first()
    assert row.device.startswith('{"probe":"probe ')


def test_work_folder_follows_the_setting(spark):
    root = session.work_root(spark)
    assert session.work_path(spark, "x").startswith(f"{root}/vecferry-x-")
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


def test_clear_work_deletes_working_files(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "shared")
    monkeypatch.setattr(session, "_configured_checkpoint_dir", lambda _: folder)
    frame = session.written(spark.range(3), "cleared")
    assert frame.count() == 3
    assert (session.clear_work(spark), session.clear_work(spark)) == (1, 0)
