import pytest
from fixtures import FIELDLESS, NO_OVERRIDES, PARTS_EXPORT, RECIPES, SIGHTINGS, write_definitions

from vecferry.functions import edm
from vecferry.operators import schema_map as sm
from vecferry.operators import transform as tr
from vecferry.sources import definitions as de


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("definitions")
    return de.load_definitions(spark, write_definitions(folder, RECIPES, SIGHTINGS, PARTS_EXPORT, FIELDLESS))


def overrides(spark, *rows):
    return spark.createDataFrame(list(rows), NO_OVERRIDES)


def converted(loaded, *rows):
    return sm.convert_fields(de.definition_fields(loaded), overrides(loaded.sparkSession, *rows))


def one(df, index, field):
    return df.filter((df.index_name == index) & (df.field_name == field)).first()


def test_type_table_has_all_known_types(spark):
    rows = edm.type_dimension(spark).collect()
    assert len(rows) == 21
    assert [sum(r.family == f for r in rows) for f in ("scalar", "collection", "vector")] == [12, 4, 5]


KNOWN_TYPES = {  # family, target type, element type, confidence, longest text, number of warnings
    "Edm.String": ("scalar", "VARCHAR", None, "exact", 65_535, 0),
    "Edm.Int32": ("scalar", "INT32", None, "exact", None, 0),
    "Edm.Int64": ("scalar", "INT64", None, "exact", None, 0),
    "Edm.Double": ("scalar", "DOUBLE", None, "exact", None, 0),
    "Edm.Single": ("scalar", "FLOAT", None, "exact", None, 0),
    "Edm.Boolean": ("scalar", "BOOL", None, "exact", None, 0),
    "Edm.DateTimeOffset": ("scalar", "VARCHAR", None, "semantic", 64, 1),
    "Edm.GeographyPoint": ("scalar", "JSON", None, "semantic", None, 1),
    "Edm.ComplexType": ("scalar", "JSON", None, "semantic", None, 1),
    "Edm.Byte": ("scalar", "INT16", None, "lossless", None, 0),
    "Edm.Int16": ("scalar", "INT16", None, "exact", None, 0),
    "Edm.SByte": ("scalar", "INT8", None, "exact", None, 0),
    "Collection(Edm.String)": ("collection", "ARRAY", "VARCHAR", "exact", None, 0),
    "Collection(Edm.Int32)": ("collection", "ARRAY", "INT32", "exact", None, 0),
    "Collection(Edm.Int64)": ("collection", "ARRAY", "INT64", "exact", None, 0),
    "Collection(Edm.Double)": ("collection", "ARRAY", "DOUBLE", "exact", None, 0),
    "Collection(Edm.Single)": ("vector", "FLOAT_VECTOR", None, "exact", None, 0),
    "Collection(Edm.Half)": ("vector", "FLOAT16_VECTOR", None, "exact", None, 0),
    "Collection(Edm.Int16)": ("vector", "FLOAT_VECTOR", None, "lossy", None, 2),
    "Collection(Edm.SByte)": ("vector", "FLOAT_VECTOR", None, "lossy", None, 2),
    "Collection(Edm.Byte)": ("vector", "BINARY_VECTOR", None, "exact", None, 0),
    "Edm.Other": ("unknown", "JSON", None, "unsupported", None, 1),
}
WITH_NOTES = {
    "Edm.Single", "Edm.DateTimeOffset", "Edm.GeographyPoint", "Edm.ComplexType", "Edm.Byte", "Collection(Edm.Int16)",
    "Collection(Edm.SByte)", "Collection(Edm.Byte)", "Edm.Other",
}


def test_every_attribute_of_every_type(spark):
    rows = sm.resolve_types(spark.createDataFrame([(t,) for t in KNOWN_TYPES], "edm_type string")).collect()
    found = {r.edm_type: (r.family, r.target_type, r.element_type, r.confidence, r.default_max_length, len(r.type_warnings)) for r in rows}
    assert found == KNOWN_TYPES
    assert {r.edm_type for r in rows if r.notes} == WITH_NOTES
    assert all(r.is_vector == (r.family == "vector") for r in rows)


def test_simple_index(loaded):
    report = sm.assess(converted(loaded)).filter("index_name = 'recipes'").first()
    assert (report.total_fields, report.skipped_fields, report.vector_fields, report.feasibility) == (6, 0, 1, "full")
    flavour = one(converted(loaded), "recipes", "flavour")
    assert (flavour.target_type, flavour.dim) == ("FLOAT_VECTOR", 96)
    assert one(converted(loaded), "recipes", "recipe_no").is_primary_key


def test_complex_index(loaded):
    fields = converted(loaded)
    types = {r.field_name: (r.target_type, r.max_length) for r in fields.filter("index_name = 'bird-sightings-eu'").collect()}
    assert len(types) == 14
    assert types["seen_at"] == ("VARCHAR", 64)
    assert types["remarks"] == ("ARRAY", 65_535)
    assert types["weights"] == ("ARRAY", None)
    assert types["observer"] == types["place"] == ("JSON", None)
    assert (types["song"], types["plumage"], types["pattern"]) == (
        ("FLOAT16_VECTOR", None), ("FLOAT_VECTOR", None), ("BINARY_VECTOR", None))
    assert one(fields, "bird-sightings-eu", "sighting").is_primary_key


def test_every_vector_field_gets_its_own_profile(loaded):
    resolved = sm.resolve_profiles(
        converted(loaded), de.definition_profiles(loaded), de.definition_algorithms(loaded)
    )
    found = {(r.index_name, r.field_name): tuple(r[c] for c in (
        "index_type", "metric_type", "param_m", "param_ef_construction", "param_ef")) for r in resolved.collect()}
    assert found == {
        ("recipes", "flavour"): ("HNSW", "IP", 12, 120, 60),
        ("bird-sightings-eu", "song"): ("FLAT", "L2", None, None, None),
        ("bird-sightings-eu", "plumage"): ("HNSW", "L2", 24, 90, 500),
        ("bird-sightings-eu", "pattern"): ("HNSW", "COSINE", 4, 400, 500),
        ("spare_parts", "shape"): ("HNSW", "HAMMING", 6, 70, 31),
    }
    specs = tr.field_specs(converted(loaded), "bird-sightings-eu", resolved=resolved)
    assert tr.target_schema(specs)["song"].metadata == {
        "target_type": "FLOAT16_VECTOR", "dim": 40, "index_type": "FLAT", "metric_type": "L2"}


@pytest.mark.parametrize("kind, metric, expected", [
    ("hnsw", "euclidean", ("HNSW", "L2", 10, 77, 33)), ("exhaustiveKnn", "dotProduct", ("FLAT", "IP", None, None, None)),
    ("other", "hamming", ("HNSW", "HAMMING", 16, 256, 256)), ("hnsw", "unknown", ("HNSW", "COSINE", 10, 77, 33)),
])
def test_vector_index_mapping(spark, kind, metric, expected):
    declared = spark.createDataFrame([(kind, metric, 10, 77, 33)], "kind string, metric string, m int, c int, s int")
    index = edm.map_vector_index(*[declared[c] for c in ("kind", "metric", "m", "c", "s")])
    assert tuple(declared.select(index.alias("i")).select("i.*").first()) == expected


def test_unsupported_features_and_warnings(loaded):
    unsupported = sm.unsupported_features(de.definition_features(loaded))
    assert {(r.index_name, r.feature) for r in unsupported.collect()} == {
        *(("bird-sightings-eu", f) for f in ("scoringProfiles", "suggesters", "semanticConfiguration")), ("announced", "suggesters")}
    warnings = sm.schema_warnings(converted(loaded), unsupported).filter("index_name = 'bird-sightings-eu'")
    assert {r.category for r in warnings.collect()} == {"type_mapping", "type_lossy", "unsupported_feature"}
    summary = sm.schema_summary(converted(loaded), unsupported).filter("index_name = 'bird-sightings-eu'").first()
    # seen_at, place and observer once each, plumage twice and as lossy, and three features
    assert (summary.warnings, summary.unsupported_features, summary.indexes) == (9, 3, 3)
    assert summary.collection == "bird_sightings_eu"


def test_an_index_without_fields_is_reported(loaded):
    indexes = de.definition_indexes(loaded)
    unsupported = sm.unsupported_features(de.definition_features(loaded))
    fields = converted(loaded)
    assert "announced" in {r.index_name for r in sm.list_indexes(de.definition_fields(loaded), indexes).collect()}
    summary = sm.schema_summary(fields, unsupported, indexes).filter("index_name = 'announced'").first()
    assert (summary.fields_total, summary.indexes, summary.unsupported_features, summary.warnings) == (0, 0, 1, 2)
    warnings = sm.schema_warnings(fields, unsupported, indexes).filter("index_name = 'announced'").collect()
    assert {r.category for r in warnings} == {"schema", "unsupported_feature"}
    counts = indexes.sparkSession.createDataFrame([("announced", 12), ("recipes", 7)], "index_name string, n_rows int")
    report = {r.index_name: r for r in sm.assess(fields, indexes, counts).collect()}
    assert (report["announced"].total_fields, report["announced"].document_count) == (0, 12)
    assert (report["recipes"].document_count, report["spare_parts"].document_count) == (7, None)


def test_rename_exclude_and_partition_key(loaded):
    fields = converted(
        loaded,
        ("recipes", "heading", False, "dish", 80, None, True),
        ("recipes", "allergens", True, None, None, None, False),
        ("bird-sightings-eu", "remarks", False, None, None, 5, True),
    )
    heading = one(fields, "recipes", "heading")
    assert (heading.target_name, heading.renamed_to, heading.max_length) == ("dish", "dish", 80)
    assert heading.is_partition_key
    allergens = one(fields, "recipes", "allergens")
    assert allergens.skipped and allergens.target_name is None
    remarks = one(fields, "bird-sightings-eu", "remarks")
    assert remarks.max_capacity == 5 and not remarks.is_partition_key
    assert sm.assess(fields).filter("index_name = 'recipes'").first().feasibility == "partial"


def test_key_of_another_type_becomes_text(spark):
    fields = spark.createDataFrame(
        [("i", 0, "k", "Edm.Double", True, 0, None, None)],
        "index_name string, ordinal long, field_name string, edm_type string, is_key boolean, n_subfields int, "
        "dimensions int, profile_name string",
    )
    row = sm.convert_fields(fields, overrides(spark)).first()
    assert (row.target_type, row.max_length, row.is_primary_key) == ("VARCHAR", 65_535, True)


def test_index_without_key_is_reported(spark, loaded):
    fields = de.definition_fields(loaded).filter("field_name not in ('recipe_no', 'part')")
    conversions = sm.convert_fields(fields, overrides(spark))
    nothing = sm.unsupported_features(de.definition_features(loaded)).limit(0)
    keyless = sm.schema_warnings(conversions, nothing).filter("category = 'schema'")
    assert {r.index_name for r in keyless.collect()} == {"recipes", "spare_parts"}


def test_compiled_schema_keeps_limits_as_metadata(loaded):
    schema = tr.target_schema(tr.field_specs(converted(loaded), "recipes"))
    assert schema.fieldNames() == ["flavour", "recipe_no", "heading", "minutes", "vegan", "allergens"]
    assert schema["recipe_no"].metadata["primary_key"] is True
    assert schema["flavour"].metadata == {"target_type": "FLOAT_VECTOR", "dim": 96}
    assert schema["heading"].metadata["max_length"] == 65_535


def test_an_index_wider_than_allowed_fails_loudly(loaded):
    with pytest.raises(ValueError, match="more than 5 fields"):
        tr.field_specs(converted(loaded), "recipes", max_fields=5)
    assert len(tr.field_specs(converted(loaded), "recipes", max_fields=6)) == 6


def test_more_vector_fields_than_allowed_fail_loudly(loaded):
    fields = converted(loaded)
    spark = fields.sparkSession
    resolved = spark.createDataFrame([("recipes", f"v{i}", "HNSW", "COSINE") for i in range(7)], "index_name string, field_name string, index_type string, metric_type string")
    with pytest.raises(ValueError, match="more than 6 vector fields"):
        tr.field_specs(fields, "recipes", max_fields=6, resolved=resolved)
    assert len(tr.field_specs(fields, "recipes", max_fields=7, resolved=resolved)) == 6
