"""Index definitions exported as JSON, flattened into the catalog tables of ``schema_map``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_SCHEMA = """
name string,
fields array<struct<name:string, type:string, key:boolean, searchable:boolean, filterable:boolean, sortable:boolean,
  facetable:boolean, dimensions:int, vectorSearchProfile:string, fields:array<struct<name:string, type:string>>>>,
vectorSearch struct<
  algorithms:array<struct<name:string, kind:string,
    hnswParameters:struct<m:int, efConstruction:int, efSearch:int, metric:string>,
    exhaustiveKnnParameters:struct<metric:string>>>,
  profiles:array<struct<name:string, algorithm:string, algorithmConfigurationName:string>>>,
scoringProfiles array<struct<name:string>>,
suggesters array<struct<name:string>>,
semantic string
"""


def load_definitions(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per index. ``multi_line`` reads one definition per file, else one per line."""
    loaded = spark.read.schema(INDEX_SCHEMA).option("multiLine", multi_line).json(path)
    return loaded.withColumn("name", F.coalesce("name", F.lit("unknown")))


def definition_indexes(definitions: DataFrame) -> DataFrame:
    """Every index of the catalog, also those that declare no field."""
    return definitions.select(F.col("name").alias("index_name")).distinct()


def definition_fields(definitions: DataFrame) -> DataFrame:
    rows = definitions.select(F.col("name").alias("index_name"), F.posexplode("fields").alias("ordinal", "f"))
    flag = {c: F.coalesce(F.col(f"f.{c}"), F.lit(False)) for c in ("searchable", "filterable", "sortable", "facetable")}
    return rows.select(
        "index_name", F.col("ordinal").cast("long").alias("ordinal"), F.col("f.name").alias("field_name"),
        F.col("f.type").alias("edm_type"), F.coalesce("f.key", F.lit(False)).alias("is_key"),
        F.coalesce(F.array_size("f.fields"), F.lit(0)).alias("n_subfields"),
        F.col("f.dimensions").alias("dimensions"), F.col("f.vectorSearchProfile").alias("profile_name"),
        *[value.alias(name) for name, value in flag.items()],
    )


def definition_profiles(definitions: DataFrame) -> DataFrame:
    rows = definitions.select(F.col("name").alias("index_name"), F.explode("vectorSearch.profiles").alias("p"))
    return rows.select(
        "index_name", F.col("p.name").alias("profile_name"),
        F.coalesce("p.algorithm", "p.algorithmConfigurationName").alias("algorithm_name"),
    )


def definition_algorithms(definitions: DataFrame) -> DataFrame:
    rows = definitions.select(F.col("name").alias("index_name"), F.explode("vectorSearch.algorithms").alias("a"))
    return rows.select(
        "index_name", F.col("a.name").alias("algorithm_name"), F.coalesce("a.kind", F.lit("hnsw")).alias("kind"),
        F.coalesce("a.exhaustiveKnnParameters.metric", "a.hnswParameters.metric").alias("metric"),
        F.col("a.hnswParameters.m").alias("m"), F.col("a.hnswParameters.efConstruction").alias("ef_construction"),
        F.col("a.hnswParameters.efSearch").alias("ef_search"),
    )


def definition_features(definitions: DataFrame) -> DataFrame:
    def declared(column: str):
        return F.coalesce(F.array_size(column) > 0, F.lit(False))

    return definitions.select(
        F.col("name").alias("index_name"), declared("scoringProfiles").alias("has_scoring_profiles"),
        declared("suggesters").alias("has_suggesters"),
        F.coalesce(~F.col("semantic").isin("", "{}", "null"), F.lit(False)).alias("has_semantic"),
    )


def write_definitions(fields: DataFrame, path: str) -> None:
    """Definitions as JSON lines, one index each; the inverse of ``definition_fields``.

    A definition is one document by nature, so its field list is gathered per index.
    """
    entry = F.struct(
        "ordinal", F.col("field_name").alias("name"), F.col("edm_type").alias("type"), F.col("is_key").alias("key"),
        "searchable", "filterable", "sortable", "facetable", "dimensions",
        F.col("profile_name").alias("vectorSearchProfile"),
        F.when(F.col("n_subfields") > 0, F.transform(
            F.sequence(F.lit(1), F.col("n_subfields")),
            lambda i: F.struct(F.concat(F.lit("sub"), i.cast("string")).alias("name"), F.lit("Edm.String").alias("type")),
        )).alias("fields"),
    )
    (
        fields.groupBy(F.col("index_name").alias("name"))
        .agg(F.array_sort(F.collect_list(entry)).alias("fields"))
        .write.json(path)
    )
