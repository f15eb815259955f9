"""Source (Edm) types, the target types they load as, and index / feature lookups."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VARCHAR_MAX_LENGTH = 65_535
ARRAY_MAX_CAPACITY = 4_096
KEY_TYPES = ("INT64", "VARCHAR")


class EdmType(NamedTuple):
    edm_type: str
    family: str
    target_type: str
    confidence: str
    element_type: str | None = None
    default_max_length: int | None = None
    notes: str = ""
    warnings: tuple[str, ...] = ()


# The type mapping users rely on.
SCALAR_TYPES = (
    EdmType("Edm.String", "scalar", "VARCHAR", "exact", default_max_length=65_535),
    EdmType("Edm.Int32", "scalar", "INT32", "exact"),
    EdmType("Edm.Int64", "scalar", "INT64", "exact"),
    EdmType("Edm.Double", "scalar", "DOUBLE", "exact"),
    EdmType("Edm.Single", "scalar", "FLOAT", "exact", notes="scalar float, not a vector"),
    EdmType("Edm.Boolean", "scalar", "BOOL", "exact"),
    EdmType(
        "Edm.DateTimeOffset", "scalar", "VARCHAR", "semantic", default_max_length=64,
        notes="kept as ISO-8601 text", warnings=("date ranges are compared as text",),
    ),
    EdmType(
        "Edm.GeographyPoint", "scalar", "JSON", "semantic",
        notes="GeoJSON point, longitude first", warnings=("distance functions are not carried over",),
    ),
    EdmType(
        "Edm.ComplexType", "scalar", "JSON", "semantic",
        notes="nested value kept as one JSON field", warnings=("nested filters become JSON path filters",),
    ),
    EdmType("Edm.Byte", "scalar", "INT16", "lossless", notes="no unsigned byte in the target"),
    EdmType("Edm.Int16", "scalar", "INT16", "exact"),
    EdmType("Edm.SByte", "scalar", "INT8", "exact"),
)
COLLECTION_TYPES = (
    EdmType("Collection(Edm.String)", "collection", "ARRAY", "exact", element_type="VARCHAR"),
    EdmType("Collection(Edm.Int32)", "collection", "ARRAY", "exact", element_type="INT32"),
    EdmType("Collection(Edm.Int64)", "collection", "ARRAY", "exact", element_type="INT64"),
    EdmType("Collection(Edm.Double)", "collection", "ARRAY", "exact", element_type="DOUBLE"),
)
VECTOR_TYPES = (
    EdmType("Collection(Edm.Single)", "vector", "FLOAT_VECTOR", "exact"),
    EdmType("Collection(Edm.Half)", "vector", "FLOAT16_VECTOR", "exact"),
    EdmType(
        "Collection(Edm.Int16)", "vector", "FLOAT_VECTOR", "lossy", notes="widened to 32-bit floats",
        warnings=("vectors take about twice the memory", "the quantised form is not kept"),
    ),
    EdmType(
        "Collection(Edm.SByte)", "vector", "FLOAT_VECTOR", "lossy", notes="widened to 32-bit floats",
        warnings=("vectors take about four times the memory", "encode again with the source model if possible"),
    ),
    EdmType("Collection(Edm.Byte)", "vector", "BINARY_VECTOR", "exact", notes="packed bits"),
)
# Metric names, index parameters where nothing or something unknown is declared, and feature keys.
METRICS = {"cosine": "COSINE", "euclidean": "L2", "dotProduct": "IP", "hamming": "HAMMING"}
DEFAULT_METRIC = "COSINE"
DECLARED_HNSW = {"M": 4, "efConstruction": 400, "ef": 500}
FALLBACK_HNSW = {"M": 16, "efConstruction": 256, "ef": 256}
UNSUPPORTED_FEATURES = {
    "scoringProfiles": "rank in the application instead",
    "suggesters": "use prefix search instead",
    "semanticConfiguration": "use a separate reranking model instead",
    "skillsets": "build a separate enrichment job instead",
    "indexers": "build a separate ingest job instead",
    "synonymMaps": "expand queries in the application instead",
    "encryptionKey": "use disk or volume encryption instead",
    "geo.distance()": "use a separate spatial store instead",
}
ATTRIBUTE_RULES = {
    "key": "primary key",
    "filterable": "automatic",
    "sortable": "automatic",
    "searchable": "BM25 ranking",
    "facetable": "GROUP BY",
    "retrievable": "automatic",
}

_TYPE_SCHEMA = T.StructType([
    T.StructField("edm_type", T.StringType(), False),
    T.StructField("family", T.StringType(), False),
    T.StructField("target_type", T.StringType(), False),
    T.StructField("confidence", T.StringType(), False),
    T.StructField("element_type", T.StringType()),
    T.StructField("default_max_length", T.IntegerType()),
    T.StructField("notes", T.StringType(), False),
    T.StructField("type_warnings", T.ArrayType(T.StringType()), False),
])


def small_table(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A fixed lookup table kept in the plan itself, so Spark knows its size."""
    columns = {f.name: [row[f.name] for row in rows] for f in schema.fields}
    return spark.createDataFrame(pa.table(columns), schema)


def pair_table(spark: SparkSession, pairs: dict[str, str], names: tuple[str, str]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType(), False) for name in names])
    return small_table(spark, [dict(zip(names, pair)) for pair in pairs.items()], schema)


def _dimension(spark: SparkSession, types: tuple[EdmType, ...]) -> DataFrame:
    rows = [{**t._asdict(), "type_warnings": list(t.warnings)} for t in types]
    return small_table(spark, rows, _TYPE_SCHEMA)


def type_dimension(spark: SparkSession) -> DataFrame:
    """All 21 known types, one row each."""
    scalar, collection, vector = (_dimension(spark, r) for r in (SCALAR_TYPES, COLLECTION_TYPES, VECTOR_TYPES))
    return scalar.unionByName(collection).unionByName(vector)


def map_metric(metric: Column) -> Column:
    """Target metric name; anything unknown or missing is COSINE."""
    names = F.create_map(*[F.lit(x) for pair in METRICS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, metric), F.lit(DEFAULT_METRIC))


def map_vector_index(kind: Column, metric: Column, m: Column, ef_construction: Column, ef_search: Column) -> Column:
    """Struct of index type, metric and parameters for one declared algorithm."""
    nothing = F.lit(None).cast("int")

    def declared(value: Column, name: str) -> Column:
        return (
            F.when(kind == "hnsw", F.coalesce(value, F.lit(DECLARED_HNSW[name])))
            .when(kind == "exhaustiveKnn", nothing)
            .otherwise(F.lit(FALLBACK_HNSW[name]))
            .cast("int")
        )

    return F.struct(
        F.when(kind == "exhaustiveKnn", F.lit("FLAT")).otherwise(F.lit("HNSW")).alias("index_type"),
        map_metric(metric).alias("metric_type"),
        declared(m, "M").alias("param_m"),
        declared(ef_construction, "efConstruction").alias("param_ef_construction"),
        declared(ef_search, "ef").alias("param_ef"),
    )
