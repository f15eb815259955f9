from pyspark.sql import functions as F

from vecferry.operators import checks as ch
from vecferry.operators import reconcile as rec
from vecferry.operators import schema_map as sm
from vecferry.functions import vectors as ve
from vecferry import workflow
from fixtures import NO_OVERRIDES


def test_count_tolerance_and_empty_source(spark):
    assert ch.check_count(spark.range(1_000), spark.range(990)).first().passed
    assert not ch.check_count(spark.range(1_000), spark.range(989)).first().passed
    assert ch.check_count(spark.range(0), spark.range(5)).first().passed


def test_fill_rate_needs_more_than_half(spark):
    half = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert not ch.check_fill_rate(half, ["a", "b"]).first().passed
    more = spark.createDataFrame([(1, 1), (None, 1)], "a int, b int")
    assert ch.check_fill_rate(more, ["a", "b"]).first().passed
    assert ch.check_fill_rate(more.limit(0), ["a", "b"]).first().passed


def test_dimension_check_ignores_absent_vectors(spark):
    rows = spark.createDataFrame([([1.0, 2.0],), (None,)], "v array<double>")
    assert ch.check_dimension(rows, "v", 2).first().passed
    assert not ch.check_dimension(rows, "v", 3).first().passed


def test_dimension_check_of_packed_vectors(spark):
    rows = spark.createDataFrame([([1.0] * 12,)], "v array<double>").select(
        ve.pack_float16(F.col("v")).alias("half"), ve.pack_bytes(ve.sign_bits(F.col("v"), 12)).alias("bits"))
    assert bytes(rows.first().bits) == b"\xff\xf0"
    assert ch.check_dimension(rows, "half", 12, "FLOAT16_VECTOR").first().passed
    assert ch.check_dimension(rows, "bits", 12, "BINARY_VECTOR").first().passed
    assert not ch.check_dimension(rows, "half", 11, "FLOAT16_VECTOR").first().passed
    assert not ch.check_dimension(rows, "bits", 17, "BINARY_VECTOR").first().passed


def test_messages_say_what_was_found(spark):
    assert ch.check_count(spark.range(200), spark.range(150)).first().message == "200 rows in the source, 150 in the target, 25.00 % apart"
    rows = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    assert ch.check_dimension(rows, "v", 3).first().message == "expected 3, found 2"


def test_repeated_rows_fail(spark):
    df = spark.range(4).select("id", (F.col("id") * 2).alias("n"))
    found = rec.reconcile(df, df.unionByName(df), "id", ["n"])
    assert tuple(found.first()) == ("n", 4, 0, 0, 0, 4)
    assert not ch.check_reconciled(found).first().passed
    assert ch.check_reconciled(rec.reconcile(df, df, "id", ["n"])).first().passed
    assert ch.check_reconciled(rec.reconcile(df.unionByName(df), df.unionByName(df), "id", ["n"])).first().passed


def test_vector_agreement_catches_bad_loads(spark):
    schema = "id int, v array<double>"
    good = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], schema)
    row = rec.vector_agreement(good, good, "id", "v").first()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, 1.0)
    bad = spark.createDataFrame([(0, None), (1, [1.0]), (2, [5.0, 10.0]), (7, [1.0, 1.0]), (4, [1.0, 4.0]), (4, [1.0, 4.0])], schema)
    found = rec.vector_agreement(good, bad, "id", "v")
    row = found.first()
    assert (row.n_compared, row.n_apart, row.n_missing, row.n_extra, row.n_duplicate, row.n_null, row.n_other_length) == (2, 1, 1, 1, 1, 1, 1)
    assert not ch.check_vectors(found, "v").first().passed
    nothing = rec.vector_agreement(good, good.limit(0), "id", "v")
    assert nothing.first().n_missing == 5 and not ch.check_vectors(nothing, "v").first().passed
    zero = spark.createDataFrame([(1, [0.0, 0.0])], schema)
    assert rec.vector_agreement(zero, zero, "id", "v").first().n_apart == 1


FIELDS = (
    "index_name string, ordinal long, field_name string, edm_type string, is_key boolean, n_subfields int, dimensions int, "
    "profile_name string"
)


def conversions_of(spark, *fields):
    rows = [("i", n, name, kind, key, 0, dim, None) for n, (name, kind, key, dim) in enumerate(fields)]
    return sm.convert_fields(spark.createDataFrame(rows, FIELDS), spark.createDataFrame([], NO_OVERRIDES))


def test_migrate_and_validate(spark, tmp_path):
    conversions = conversions_of(
        spark, ("k", "Edm.Int64", True, None), ("t", "Edm.String", False, None), ("v", "Collection(Edm.Single)", False, 2),
        ("h", "Collection(Edm.Half)", False, 2), ("odd", "Edm.Unknown", False, None))
    source = spark.range(20).select(
        F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("t"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("v"),
        F.array(F.lit(0.5), F.lit(0.25)).alias("h"), F.lit("no json").alias("odd"), F.lit(1).alias("@search.score"))
    done = workflow.migrate(source, conversions, "i", str(tmp_path / "good"))
    assert (done.accepted, done.rejected) == (20, 0)
    stored = done.stored(spark)
    assert stored.first().odd == '{"value":"no json"}'
    checked = workflow.validate(conversions, "i", source, stored)
    assert {r.name: r.passed for r in checked.collect()} == dict.fromkeys([
        "document_count", "field_count", "fill_rate", "vector_dim_v", "vector_dim_h", "values", "vector_values_v"], True)
    scaled = stored.withColumn("v", F.transform("v", lambda x: x * 2)).unionByName(stored.limit(1))
    failed = {r.name for r in workflow.validate(conversions, "i", source, scaled).collect() if not r.passed}
    assert failed == {"document_count", "values", "vector_values_v"}


def test_an_index_without_a_key_gets_one(spark, tmp_path):
    conversions = conversions_of(spark, ("t", "Edm.String", False, None), ("n", "Edm.Int32", False, None))
    source = spark.createDataFrame([("a", 1), ("b", 2), ("b", None)], "t string, n int")
    done = workflow.migrate(source, conversions, "i", str(tmp_path / "keyless"))
    stored = done.stored(spark)
    assert stored.count() == 3 and stored.select("_generated_id").distinct().count() == 3
    again = workflow.migrate(source.repartition(2), conversions, "i", str(tmp_path / "again")).stored(spark)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, stored.collect()))
    assert all(r.passed for r in workflow.validate(conversions, "i", source, stored).collect())


def test_roll_up(spark):
    checks = ch.check_count(spark.range(10), spark.range(10)).unionByName(ch.check_columns(3, spark.range(1)))
    row = ch.roll_up(checks).first()
    assert (row.all_passed, row.n_passed, row.n_failed, row.summary) == (False, 1, 1, "[FAIL] 1/2 checks passed")


def test_a_table_agrees_with_itself(spark):
    df = spark.range(500).select(
        "id", F.when(F.col("id") % 5 != 0, F.md5(F.col("id").cast("string"))).alias("text"), F.array("id").alias("list")
    )
    for digest in (False, True):
        for row in rec.reconcile(df, df, "id", ["text", "list"], digest).collect():
            assert (row.n_match, row.n_different, row.n_missing, row.n_extra) == (500, 0, 0, 0)


def test_differences_are_told_apart(spark):
    left = spark.createDataFrame([(1, "a", None), (2, "b", 2), (3, "c", 3)], "k int, t string, n int")
    right = spark.createDataFrame([(1, "a", 1), (2, None, 2), (4, "d", 4)], "k int, t string, n int")
    for digest in (False, True):
        got = {r.field: r[1:] for r in rec.reconcile(left, right, "k", ["t", "n"], digest).collect()}
        assert got == {"t": (1, 1, 1, 1, 0), "n": (1, 1, 1, 1, 0)}
    assert [r.k for r in rec.missing_in_target(left, right, "k").collect()] == [3]
    assert sorted(r.k for r in rec.already_loaded(left, right, "k").collect()) == [1, 2]
