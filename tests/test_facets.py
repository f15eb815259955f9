from pyspark.sql import functions as F

from vecferry.operators import facets
from vecferry.sources import target as tg

ROWS = [(1, "a", 3, ["x", "y", "x"]), (2, "a", None, []), (3, None, 3, None), (4, "b", 4, ["y", None])]


def test_all_facets_equal_the_single_ones_in_one_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, "id int, kind string, size int, tags array<string>").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    found = facets.all_facets(rows, ["kind", "size", "tags"])
    single = []
    for column in ("kind", "size"):
        single += [(column, r.value if r.value is None else str(r.value), r.n_documents) for r in facets.facet_counts(rows, column).collect()]
    single += [("tags", r.value, r.n_documents) for r in facets.array_facet_counts(rows, "tags").collect()]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(single, key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Expand" in plan
    assert sorted(map(tuple, facets.all_facets(rows, ["kind"]).collect()), key=repr) == sorted((s for s in single if s[0] == "kind"), key=repr)
    assert sorted(map(tuple, facets.all_facets(rows, ["tags"]).collect()), key=repr) == sorted((s for s in single if s[0] == "tags"), key=repr)
    assert facets.all_facets(rows.filter("false"), ["kind", "tags"]).collect() == []


def test_reports_are_bounded_in_parts(spark):
    fields = spark.range(25).select(F.lit("wide").alias("index_name"), F.col("id").alias("ordinal"), F.concat(F.lit("f"), "id").alias("field_name"))
    fields = fields.unionByName(spark.createDataFrame([("small", 0, "only")], "index_name string, ordinal long, field_name string"))
    indexes = spark.createDataFrame([("wide", "f3", "HNSW"), ("loose", "v", "FLAT")], "index_name string, field_name string, index_type string")
    got = {(r.index_name, r.part): r for r in tg.index_reports(fields, indexes, 10).collect()}
    assert sorted(got) == [("loose", 0), ("small", 0), ("wide", 0), ("wide", 1), ("wide", 2)]
    assert [f.field_name for f in got["wide", 1].fields] == [f"f{i}" for i in range(10, 20)]
    assert [len(got["wide", p].fields) for p in range(3)] == [10, 10, 5] and got["wide", 0].n_parts == 3
    assert [i.index_type for i in got["wide", 0].indexes] == ["HNSW"] and got["wide", 1].indexes == []
    assert got["loose", 0].fields == [] and got["small", 0].indexes == []
