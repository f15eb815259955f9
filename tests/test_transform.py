import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecferry.functions import vectors as ve
from vecferry.functions.coerce import FieldSpec
from vecferry.operators import transform as tr

SPECS = [
    FieldSpec("id", "id", "VARCHAR", max_length=65_535, is_key=True),
    FieldSpec("title", "title", "VARCHAR", max_length=65_535),
    FieldSpec("price", "price", "DOUBLE"),
    FieldSpec("in_stock", "in_stock", "BOOL"),
    FieldSpec("tags", "tags", "ARRAY", element_type="VARCHAR"),
    FieldSpec("embedding", "embedding", "FLOAT_VECTOR"),
]
SCHEMA = "id string, title string, price double, in_stock boolean, tags array<string>, embedding array<float>"
ROWS = [
    ("doc-001", "First", 29.99, True, ["a", "b", "c"], [0.1] * 4),
    ("doc-002", "Second", 49.99, False, ["a", "b"], [0.2] * 4),
    ("doc-003", "Third", 0.0, True, [], [0.3] * 4),
]


def transformed(spark, rows, schema=SCHEMA, specs=SPECS, **options):
    return tr.transform_documents(spark.createDataFrame(rows, schema), specs, **options)


def test_good_documents_pass_unchanged(spark):
    rows = tr.accepted(transformed(spark, ROWS)).orderBy("id").collect()
    assert [(r.id, r.title, r.price, r.in_stock, r.tags) for r in rows] == [r[:5] for r in ROWS]


def test_missing_key_is_rejected_but_empty_key_is_kept(spark):
    out = transformed(spark, [(None, "x", 1.0, True, [], None), ("", "y", 1.0, True, [], None)])
    assert [r[tr.REASON] for r in tr.rejected(out).collect()] == ["missing key id"]
    assert tr.accepted(out).first().title == "y"


def test_nulls_become_defaults_and_vectors_stay_absent(spark):
    row = tr.accepted(transformed(spark, [("k", None, None, None, None, None)])).first()
    assert (row.title, row.price, row.in_stock, row.tags, row.embedding) == ("", 0.0, False, [], None)
    bare = tr.accepted(transformed(spark, [("k", None, None, None, None, None)], defaults=False)).first()
    assert (bare.title, bare.price, bare.tags) == (None, None, None)


def test_text_is_cut_by_characters(spark):
    row = tr.accepted(transformed(spark, [("k", "x" * 100_000, 0.0, True, [], None)])).first()
    assert len(row.title) == 65_535
    specs = [SPECS[0], FieldSpec("title", "title", "VARCHAR", max_length=2)]
    assert tr.accepted(transformed(spark, [("k", "日本語", 0.0, True, [], None)], specs=specs)).first().title == "日本"


def test_integer_vectors_become_floats(spark):
    schema = "id string, embedding array<int>"
    row = tr.accepted(transformed(spark, [("k", [1, 2, 3, 0])], schema, [SPECS[0], SPECS[5]])).first()
    assert row.embedding == [1.0, 2.0, 3.0, 0.0]


def test_undeclared_and_missing_columns(spark):
    out = transformed(spark, [("k", 1)], "id string, extra int", keep_dynamic=True)
    row = tr.accepted(out).first()
    assert row.title == "" and row["$meta"] == '{"extra":1}'


def test_excluded_field_is_absent(spark):
    assert "tags" not in transformed(spark, ROWS, specs=[s for s in SPECS if s.target != "tags"]).columns


@pytest.mark.parametrize("kind, source, value, expected", [
    ("INT32", "double", 1.9, 1), ("INT32", "double", -1.9, -1), ("INT32", "string", " 12 ", 12), ("INT64", "string", "\t42\n", 42), ("DOUBLE", "string", "\r1.5\t", 1.5),
    ("INT32", "string", "1.5", None), ("INT32", "string", "x", None), ("INT8", "int", 128, None), ("INT8", "int", -128, -128),
    ("INT16", "double", 32767.9, 32767), ("INT16", "double", 32768.0, None), ("INT64", "string", "9223372036854775807", 2**63 - 1),
    ("INT64", "string", "9223372036854775808", None), ("INT64", "double", 1e300, None), ("INT32", "double", float("nan"), None),
    ("DOUBLE", "string", "1e5", 1e5), ("DOUBLE", "string", "1.5f", None), ("DOUBLE", "int", 3, 3.0),
    ("BOOL", "string", "false", True), ("BOOL", "string", "", False), ("BOOL", "double", 0.0, False), ("BOOL", "int", 5, True),
    ("VARCHAR", "int", 5, "5"), ("VARCHAR", "boolean", True, "true"),
    ("JSON", "string", '{"a": 1}', '{"a": 1}'), ("JSON", "string", "{bad", None), ("JSON", "int", 4, '{"value":4}'),
])
def test_scalar_coercion(spark, kind, source, value, expected):
    specs = [FieldSpec("k", "k", "INT32", is_key=True), FieldSpec("v", "v", kind)]
    row = transformed(spark, [(1, value)], f"k int, v {source}", specs, defaults=False).first()
    assert row.v == expected
    assert (row[tr.REASON] is None) == (expected is not None)


@pytest.mark.parametrize("element, source, value, expected", [
    ("VARCHAR", "array<int>", [1, None], ["1", None]), ("INT32", "array<string>", ["1", "2"], [1, 2]),
    ("INT32", "array<string>", ["1", "x"], None), ("INT64", "array<int>", [1, None], None),
    ("DOUBLE", "array<int>", [1], [1.0]), ("VARCHAR", "string", "one", ["one"]),
])
def test_array_coercion(spark, element, source, value, expected):
    specs = [FieldSpec("k", "k", "INT32", is_key=True), FieldSpec("v", "v", "ARRAY", element_type=element)]
    row = transformed(spark, [(1, value)], f"k int, v {source}", specs, defaults=False).first()
    assert row.v == expected
    assert (row[tr.REASON] is None) == (expected is not None)


def test_wrong_dimension_and_bad_bytes_are_rejected(spark):
    specs = [
        FieldSpec("k", "k", "INT32", is_key=True), FieldSpec("v", "v", "FLOAT_VECTOR", dim=3),
        FieldSpec("b", "b", "BINARY_VECTOR"),
    ]
    rows = [(1, [1.0, 2.0, 3.0], [0, 255]), (2, [1.0], [0]), (3, [1.0, 2.0, 3.0], [256])]
    out = {r.k: r for r in transformed(spark, rows, "k int, v array<double>, b array<int>", specs).collect()}
    assert out[1][tr.REASON] is None and bytes(out[1].b) == b"\x00\xff"
    assert out[2][tr.REASON] == "wrong dimension in v"
    assert out[3][tr.REASON] == "bad value in b"


def test_packed_vectors_of_the_wrong_length_are_rejected(spark):
    specs = [
        FieldSpec("k", "k", "INT32", is_key=True), FieldSpec("h", "h", "FLOAT16_VECTOR", dim=3), FieldSpec("b", "b", "BINARY_VECTOR", dim=12),
    ]
    rows = [(1, [1.0, 2.0, 3.0], [1, 2]), (2, [1.0, 2.0], [1, 2]), (3, [1.0, 2.0, 3.0], [1]), (4, None, None)]
    out = {r.k: r[tr.REASON] for r in transformed(spark, rows, "k int, h array<double>, b array<int>", specs).collect()}
    assert out == {1: None, 2: "wrong dimension in h", 3: "wrong dimension in b", 4: None}


def test_text_of_an_unknown_type_is_wrapped(spark):
    specs = [FieldSpec("k", "k", "INT32", is_key=True), FieldSpec("v", "v", "JSON", wrap_text=True)]
    rows = [(1, "plain words"), (2, '{"a":1}'), (3, None)]
    out = {r.k: (r.v, r[tr.REASON]) for r in transformed(spark, rows, "k int, v string", specs, defaults=False).collect()}
    assert out == {1: ('{"value":"plain words"}', None), 2: ('{"a":1}', None), 3: (None, None)}


def test_bytes_and_empty_bytes_to_floats(spark):
    specs = [FieldSpec("k", "k", "INT32", is_key=True), FieldSpec("v", "v", "FLOAT_VECTOR")]
    out = transformed(spark, [(1, bytearray(b"\x00\x7f\xff")), (2, bytearray())], "k int, v binary", specs)
    assert {r.k: r.v for r in out.collect()} == {1: [0.0, 127.0, 255.0], 2: []}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-65_000, 65_000, width=32), min_size=1, max_size=40))
def test_half_floats_match_the_standard_packing(spark, values):
    packed = spark.createDataFrame([(values,)], "v array<double>").select(ve.pack_float16(F.col("v")).alias("p")).first().p
    assert bytes(packed) == b"".join(struct.pack("<e", v) for v in values)


def test_half_floats_of_null_and_empty_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0]), (2, None), (3, []), (4, [2.0, 3.0])], "k int, v array<double>").coalesce(1)
    out = {r.k: r.p if r.p is None else bytes(r.p) for r in rows.select("k", ve.pack_float16(F.col("v")).alias("p")).collect()}
    assert out == {1: struct.pack("<e", 1), 2: None, 3: b"", 4: struct.pack("<2e", 2, 3)}


def test_half_float_overflow_is_rejected(spark):
    specs = [FieldSpec("k", "k", "INT32", is_key=True), FieldSpec("v", "v", "FLOAT16_VECTOR")]
    out = transformed(spark, [(1, [65_504.0]), (2, [70_000.0])], "k int, v array<double>", specs)
    assert {r.k: r[tr.REASON] for r in out.collect()} == {1: None, 2: "bad value in v"}


def test_metadata_columns_are_stripped(spark):
    df = spark.range(1).select("id", F.lit(1).alias("@search.score"), F.lit(2).alias("a.b"))
    assert tr.strip_metadata(df).columns == ["id", "a.b"]


def test_unit_vectors(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "v array<double>, z array<double>").select(
        ve.normalize(F.col("v")).alias("v"), ve.normalize(F.col("z")).alias("z")).first()
    assert row.v == [0.6, 0.8] and row.z == [None, None]


def test_counts_add_up(spark):
    rows = [(None if i % 3 == 0 else str(i), "t", 1.0, True, [], None) for i in range(30)]
    counts = tr.transform_counts(transformed(spark, rows)).first()
    assert (counts.total, counts.accepted, counts.rejected) == (30, 20, 10)


def test_array_limits(spark):
    rows = [(1, ["a", "b", "c"]), (2, ["abcdef"]), (3, ["a"])]
    df = spark.createDataFrame(rows, "k int, tags array<string>")
    found = {r.k: (r.over_capacity, r.over_length) for r in tr.array_limits(df, "k", "tags", 2, 5).collect()}
    assert found == {1: (True, False), 2: (False, True)}
    fitted = [r.t for r in df.select(tr.fit_array(F.col("tags"), 2, 5).alias("t")).collect()]
    assert fitted == [["a", "b"], ["abcde"], ["a"]]


def test_time_text_does_not_depend_on_the_session_time_zone(spark):
    from vecferry.functions.coerce import iso_text

    df = spark.sql("SELECT timestamp_micros(1710054000123456) AS t, timestamp_ntz'2024-03-10 02:30:00.5' AS n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    for other in ("America/New_York", "Asia/Kolkata", zone):
        spark.conf.set("spark.sql.session.timeZone", other)
        row = df.select(*[iso_text(df[c], df.schema[c].dataType).alias(c) for c in df.columns]).first()
        assert tuple(row) == ("2024-03-10T07:00:00.123456Z", "2024-03-10T02:30:00.500000Z")
