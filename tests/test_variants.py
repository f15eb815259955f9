from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.functions import predicates as pr
from vecferry.functions import variants as va
from vecferry.functions.coerce import FieldSpec
from vecferry.operators import transform as tr

TEXTS = [(1, '{"k": 7, "a": {"b": ["x", "y"]}}'), (2, '{"k": "12"}'), (3, "{bad"), (4, None), (5, '{"k": null}'), (6, '{"k": 60.5}'), (7, "[1]")]


def test_paths_equal_those_of_text(spark, tmp_path):
    rows = spark.createDataFrame(TEXTS, "id int, props string")
    rows.select("*", va.parsed("props").alias("v")).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert va.variant_columns(stored) == ["v"]
    got = {r.id: r[1:] for r in stored.select("id", va.at("v", "$.k", "int"), va.at("v", "$.a.b[1]"), pr.json_path("props", "$.k", "int")).collect()}
    assert got[1] == (7, "y", 7) and got[2][0] == got[2][2] == 12
    assert all(got[i][:2] == (None, None) for i in (3, 4, 5, 7)) and got[6][0] == 60
    assert stored.filter("v is null").count() == 2


def test_shape_of_a_column(spark):
    rows = spark.createDataFrame([(1, '{"k": 7}'), (2, '{"k": 8, "m": "x"}')], "id int, props string").select(va.parsed("props").alias("v"))
    assert va.shape(rows, "v") == "OBJECT<k: BIGINT, m: STRING>"


def test_dynamic_fields_keep_their_types(spark):
    rows = spark.createDataFrame([(1, 2.5, None, [1, 2])], "id long, score double, note string, tags array<int>").withColumn("@s", F.lit(1))
    made = tr.transform_documents(rows, [FieldSpec("id", "id", "INT64", is_key=True)], keep_dynamic="variant")
    assert isinstance(made.schema["$meta"].dataType, T.VariantType)
    one = made.withColumnRenamed("$meta", "m").select(
        va.at("m", "$.score", "double"), va.at("m", "$.note"), va.at("m", "$.tags[1]", "int"), va.at("m", "$.id", "long"), F.schema_of_variant("m")).first()
    assert one[:4] == (2.5, None, 2, None) and one[4] == "OBJECT<note: VOID, score: DOUBLE, tags: ARRAY<BIGINT>>"
    only = tr.transform_documents(rows.select("id"), [FieldSpec("id", "id", "INT64", is_key=True)], keep_dynamic="variant")
    assert only.withColumnRenamed("$meta", "m").select(F.to_json("m")).first()[0] == "{}"
