from pyspark.sql import functions as F

from vecferry.operators import batches as ba


def test_numbering_follows_key_order_and_stays_the_same(spark, tmp_path):
    keys = spark.range(5_000).select(F.md5(F.col("id").cast("string")).alias("key"))
    numbered = ba.number_rows(keys, [F.col("key")], 7, str(tmp_path / "n"))
    expected = {k: i + 1 for i, k in enumerate(sorted(r.key for r in keys.collect()))}
    for _ in range(2):
        assert {r.key: r._rn for r in numbered.collect()} == expected


def test_numbering_with_a_third_of_the_rows_on_one_value(spark):
    rows = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("score"))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    numbered = ba.number_rows(rows, [F.col("score").desc(), F.col("id")], 8)
    expected = sorted(rows.collect(), key=lambda r: (-r.score, r.id))
    assert [r.id for r in numbered.orderBy("_rn").collect()] == [r.id for r in expected]
    assert [r._rn for r in numbered.orderBy("_rn").collect()] == list(range(1, 3_001))


def test_batches_skip_and_progress(spark):
    numbered = ba.number_rows(spark.range(1_050).select(F.col("id").alias("key")), [F.col("key")], 3)
    stats = ba.batch_stats(numbered, 100, "key").orderBy("batch").collect()
    assert [r.n_rows for r in stats] == [100] * 10 + [50]
    assert [r.migrated for r in stats] == [*range(100, 1_001, 100), 1_050]
    assert stats[-1].last_key == 1_049
    assert ba.skip_rows(numbered, 1_000).count() == 50


def test_empty_table(spark):
    assert ba.number_rows(spark.range(0).select(F.col("id").alias("key")), [F.col("key")], 3).count() == 0


def test_running_sums_across_blocks(spark):
    df = spark.range(1_000).select(F.col("id").alias("batch"), (F.col("id") % 7).alias("n"))
    got = {r.batch: r.running_n for r in ba.running_sums(df, "batch", ["n"], width=8).collect()}
    total = 0
    for i in range(1_000):
        total += i % 7
        assert got[i] == total
