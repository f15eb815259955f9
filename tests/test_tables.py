import uuid

import pytest
from pyspark.sql import functions as F

from vecferry.functions.coerce import FieldSpec
from vecferry.operators import postings, reconcile, text
from vecferry.sources import tables

SPECS = [FieldSpec("id", "id", "INT64", is_key=True), FieldSpec("name", "name", "VARCHAR", max_length=9), FieldSpec("n", "n", "INT32")]


@pytest.fixture
def name(spark):
    made = f"t_{uuid.uuid4().hex}"
    yield made
    for each in (made, f"{made}_b"):
        spark.sql(f"DROP TABLE IF EXISTS {each}")


def rows(spark, first, last):
    return spark.range(first, last).select("id", F.concat(F.lit("r"), "id").alias("name"), (F.col("id") % 7).cast("int").alias("n"))


def exchanges(frame):
    """Exchanges of the plan that ran, but those to one partition for a total."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange" in line and "SinglePartition" not in line]


def test_table_is_created_once_kept_dropped_and_resumed(spark, name, tmp_path):
    assert not tables.table_exists(spark, name)
    assert tables.create_table(spark, name, SPECS, 4, path=str(tmp_path / "t"))
    assert tables.table_exists(spark, name) and spark.table(name).schema["name"].metadata["max_length"] == 9
    assert tables.append_table(rows(spark, 0, 50), name) == 50
    assert not tables.create_table(spark, name, SPECS, 4)
    assert tables.load_missing(rows(spark, 25, 80), name) == 30
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(80))
    assert tables.bucketing(spark, name) == (4, ["id"])
    assert tables.create_table(spark, name, SPECS, 8, drop_existing=True, path=str(tmp_path / "t2"))
    assert spark.table(name).count() == 0 and tables.bucketing(spark, name) == (8, ["id"])
    with pytest.raises(ValueError, match="one key"):
        tables.create_table(spark, f"{name}_b", SPECS[1:])


def test_an_append_adds_one_file_per_bucket(spark, name, tmp_path):
    tables.save_table(rows(spark, 0, 500), name, "id", 4, str(tmp_path / "t"))
    before = len(list((tmp_path / "t").glob("*.parquet")))
    tables.append_table(rows(spark, 500, 1000).repartition(16), name)
    assert (before, len(list((tmp_path / "t").glob("*.parquet")))) == (4, 8)


def test_tables_meet_on_their_key_without_a_shuffle(spark, name, tmp_path):
    other = f"{name}_b"
    tables.save_table(rows(spark, 0, 400), name, "id", 4, str(tmp_path / "a"))
    tables.save_table(rows(spark, 0, 300).withColumn("n", F.when(F.col("id") == 9, -1).otherwise(F.col("n"))), other, "id", 4, str(tmp_path / "b"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = spark.table(name), spark.table(other)
        missing = reconcile.missing_in_target(left, right, "id")
        assert exchanges(missing) == [] and missing.count() == 100
        pairs = reconcile.paired(left, right, "id", ["name", "n"])
        assert exchanges(pairs) == []
        found = reconcile.reconcile(left, right, "id", ["name", "n"])
        assert exchanges(found) == []
        assert {r.field: (r.n_match, r.n_different, r.n_missing) for r in found.collect()} == {"name": (300, 0, 100), "n": (299, 1, 100)}
        plain = spark.read.parquet(str(tmp_path / "b"))
        assert exchanges(reconcile.missing_in_target(left, plain, "id")) != []  # what buckets spare
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


TEXTS = [(1, "the cat sat on the mat"), (2, "the dog ate"), (3, "a cat and a dog and a bird"), (4, None), (5, ""), (6, "mat mat mat")]


def test_stored_postings_rank_as_texts_do_and_read_their_buckets_alone(spark, tmp_path):
    documents = spark.createDataFrame(TEXTS, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "Cat mat"), (2, "bird"), (3, "nothing"), (4, None)], "query_id long, text string")
    path = str(tmp_path / "p")
    postings.add_documents(documents.filter("doc_id < 4"), path, buckets=16)
    postings.add_documents(documents.filter("doc_id >= 4"), path, buckets=16)
    best = sorted(map(tuple, postings.search_stored(spark, path, asked, 5).collect()))
    assert best == sorted(map(tuple, text.bm25_search(documents, asked, 5).collect())) and best
    one = postings.postings_of(spark, path, text.query_terms(asked.filter("query_id = 2"), "text"), 16)
    assert [r.doc_id for r in one.collect()] == [3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan.replace("`", "") or "PartitionFilters: [bucket" in plan
    assert "In(term" in plan or "EqualTo(term" in plan
    read = {r[0] for r in one.select(F.regexp_extract(F.col("_metadata.file_path"), "bucket=([0-9]+)", 1)).distinct().collect()}
    assert len(read) == 1


def test_additions_with_other_buckets_fail_loudly(spark, tmp_path):
    documents, path = spark.createDataFrame(TEXTS, "doc_id long, text string"), str(tmp_path / "p")
    postings.add_documents(documents.filter("doc_id < 4"), path, buckets=16)
    postings.add_documents(documents.filter("doc_id >= 4"), path, buckets=8)
    with pytest.raises(ValueError, match="16"):
        postings.corpus_size(spark, path)
