"""Schema conversion for a whole catalog of index definitions.

Input tables
  fields      index_name, ordinal, field_name, edm_type, is_key, n_subfields, dimensions, profile_name
  overrides   index_name, field_name, excluded, target_name, max_length, max_capacity, is_partition_key
  profiles    index_name, profile_name, algorithm_name
  algorithms  index_name, algorithm_name, kind, metric, m, ef_construction, ef_search
  features    index_name, has_scoring_profiles, has_suggesters, has_semantic

Only the 21-row type table and the 8-row feature table are broadcast by hint. Every other lookup is
a plain equi-join, so Spark broadcasts it only when its measured size allows, and AQE splits an
index that holds a large share of the fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecferry.functions import edm


def resolve_types(fields: DataFrame, type_column: str = "edm_type") -> DataFrame:
    """Left lookup of the type table; unknown types load as JSON and are marked unsupported."""
    spark = fields.sparkSession
    known = edm.type_dimension(spark).withColumnRenamed("edm_type", "_known_type")
    looked_up = fields.join(F.broadcast(known), F.col(type_column) == F.col("_known_type"), "left")
    unknown = F.col("_known_type").isNull()
    return (
        looked_up.withColumn("family", F.when(unknown, "unknown").otherwise(F.col("family")))
        .withColumn("target_type", F.when(unknown, "JSON").otherwise(F.col("target_type")))
        .withColumn("confidence", F.when(unknown, "unsupported").otherwise(F.col("confidence")))
        .withColumn("is_vector", F.col("family") == "vector")
        .withColumn("notes", F.when(unknown, "unknown type, kept as JSON").otherwise(F.col("notes")))
        .withColumn(
            "type_warnings",
            F.when(unknown, F.array(F.lit("unknown type, stored as JSON"))).otherwise(F.col("type_warnings")),
        )
        .drop("_known_type")
    )


def effective_type(excluded: Column) -> Column:
    """A converted field with sub-fields is a complex value, whatever type it declares."""
    return F.when(~excluded & (F.col("n_subfields") > 0), F.lit("Edm.ComplexType")).otherwise(F.col("edm_type"))


def complex_fields(fields: DataFrame) -> DataFrame:
    """Fields whose sub-fields turn them into complex values."""
    return fields.filter(F.col("n_subfields") > 0).withColumn("effective_type", effective_type(F.lit(False)))


def collection_name(index_name: Column, override: Column | None = None) -> Column:
    renamed = F.replace(index_name, F.lit("-"), F.lit("_"))
    return renamed if override is None else F.coalesce(override, renamed)


def key_fields(fields: DataFrame) -> DataFrame:
    """First declared key field of every index; null where an index has none."""
    ordinal = F.when(F.col("is_key"), F.col("ordinal"))
    return fields.groupBy("index_name").agg(F.min_by("field_name", ordinal).alias("key_field"))


def list_indexes(fields: DataFrame, indexes: DataFrame | None = None) -> DataFrame:
    """``indexes`` (index_name) has all of the catalog; from ``fields`` alone an index without fields is not seen."""
    return (fields if indexes is None else indexes).select("index_name").distinct()


def _with_fieldless(per_index: DataFrame, indexes: DataFrame | None, zeros: list[str]) -> DataFrame:
    """Adds the indexes that declare no field, with counts of 0."""
    return per_index if indexes is None else list_indexes(indexes).join(per_index, "index_name", "left").fillna(0, zeros)


def convert_fields(
    fields: DataFrame,
    overrides: DataFrame,
    varchar_max_length: int = edm.VARCHAR_MAX_LENGTH,
    array_max_capacity: int = edm.ARRAY_MAX_CAPACITY,
) -> DataFrame:
    """One row per field: what it becomes in the target, or why it is left out."""
    options = overrides.select(
        "index_name", "field_name", "excluded", "target_name",
        F.col("max_length").alias("_max_length"), F.col("max_capacity").alias("_max_capacity"),
        F.col("is_partition_key").alias("_partition"),
    )
    joined = fields.join(options, ["index_name", "field_name"], "left")
    excluded = F.coalesce(F.col("excluded"), F.lit(False))
    typed = resolve_types(
        joined.withColumn("skipped", excluded).withColumn("effective_type", effective_type(excluded)),
        "effective_type",
    )
    kept = ~F.col("skipped")
    mapped = F.col("target_type")
    is_key = F.col("is_key")
    rekeyed = is_key & ~mapped.isin(*edm.KEY_TYPES)
    declared = F.when(rekeyed, "VARCHAR").otherwise(mapped)
    max_length = (
        F.when(
            mapped == "VARCHAR",
            F.coalesce(F.col("_max_length"), F.col("default_max_length"), F.lit(varchar_max_length)),
        )
        .when(
            (mapped == "ARRAY") & (F.col("element_type") == "VARCHAR"),
            F.coalesce(F.col("_max_length"), F.lit(varchar_max_length)),
        )
        .when(rekeyed, F.lit(varchar_max_length))
    )
    name = F.coalesce(F.col("target_name"), F.col("field_name"))
    return typed.select(
        "index_name", "ordinal", "field_name",
        F.col("effective_type").alias("edm_type"),
        F.when(kept, name).alias("target_name"),
        F.when(kept, declared).alias("target_type"),
        F.when(kept & (mapped == "ARRAY"), F.col("element_type")).alias("element_type"),
        F.when(kept, max_length).alias("max_length"),
        F.when(kept & (mapped == "ARRAY"), F.coalesce(F.col("_max_capacity"), F.lit(array_max_capacity))).alias(
            "max_capacity"
        ),
        F.when(kept & F.col("is_vector") & (F.col("dimensions") > 0), F.col("dimensions")).alias("dim"),
        "confidence", "is_vector",
        (is_key & kept).alias("is_primary_key"),
        (kept & F.coalesce(F.col("_partition"), F.lit(False)) & declared.isin(*edm.KEY_TYPES)).alias(
            "is_partition_key"
        ),
        "skipped",
        F.when(F.col("skipped"), "excluded by option").alias("skip_reason"),
        F.when(kept & (name != F.col("field_name")), name).alias("renamed_to"),
        "notes", "type_warnings", "profile_name",
    )


def resolve_profiles(conversions: DataFrame, profiles: DataFrame, algorithms: DataFrame) -> DataFrame:
    """Vector index of every kept vector field, from the profile the field itself names."""
    vectors = conversions.filter(F.col("is_vector") & ~F.col("skipped"))
    joined = (
        vectors.select("index_name", "field_name", "target_name", "profile_name")
        .join(profiles, ["index_name", "profile_name"], "left")
        .join(algorithms, ["index_name", "algorithm_name"], "left")
    )
    found = F.col("_found")
    settled = joined.withColumn("_found", F.col("kind").isNotNull())
    index = edm.map_vector_index(
        F.coalesce(F.col("kind"), F.lit("hnsw")), F.col("metric"),
        F.col("m"), F.col("ef_construction"), F.col("ef_search"),
    )
    return settled.select(
        "index_name", "field_name", "target_name",
        F.when(found, F.col("profile_name")).otherwise(F.lit("")).alias("profile_name"),
        F.coalesce(F.col("kind"), F.lit("hnsw")).alias("algorithm_kind"),
        F.coalesce(F.col("metric"), F.lit("cosine")).alias("metric"),
        index.alias("_index"),
    ).select("*", "_index.*").drop("_index")


def unsupported_features(features: DataFrame) -> DataFrame:
    """One row per index and declared feature that has no counterpart."""
    spark = features.sparkSession
    messages = edm.pair_table(spark, edm.UNSUPPORTED_FEATURES, ("feature", "message"))
    present = F.array_compact(F.array(
        F.when(F.col("has_scoring_profiles"), F.lit("scoringProfiles")),
        F.when(F.col("has_suggesters"), F.lit("suggesters")),
        F.when(F.col("has_semantic"), F.lit("semanticConfiguration")),
    ))
    return (
        features.select("index_name", F.explode(present).alias("feature"))
        .join(F.broadcast(messages), "feature", "left")
        .select("index_name", "feature", "message")
    )


def schema_warnings(conversions: DataFrame, unsupported: DataFrame, indexes: DataFrame | None = None) -> DataFrame:
    """Type, lossy, missing-key and feature warnings in one table; ``indexes`` as in ``list_indexes``."""
    def warning(category: str, message: Column) -> Column:
        return F.struct(F.lit(category).alias("category"), message.alias("message"))

    lossy_text = F.concat(F.lit("field '"), "field_name", F.lit("' ("), "edm_type", F.lit(") loses precision"))
    per_field = F.concat(
        F.transform("type_warnings", lambda message: warning("type_mapping", message)),
        F.array_compact(F.array(F.when(F.col("confidence") == "lossy", warning("type_lossy", lossy_text)))),
    )
    of_fields = conversions.select("index_name", "field_name", F.explode(per_field).alias("w")).select(
        "index_name", "field_name", "w.category", "w.message"
    )
    keyed = _with_fieldless(conversions.groupBy("index_name").agg(F.bool_or("is_primary_key").alias("has_key")), indexes, [])
    keyless = (
        keyed.filter(~F.coalesce("has_key", F.lit(False)))
        .select(
            "index_name", F.lit("").alias("field_name"), F.lit("schema").alias("category"),
            F.lit("no key field, ids are generated").alias("message"),
        )
    )
    of_feature = unsupported.select(
        "index_name", F.lit("").alias("field_name"), F.lit("unsupported_feature").alias("category"), "message"
    )
    return of_fields.unionByName(keyless).unionByName(of_feature)


def schema_summary(conversions: DataFrame, unsupported: DataFrame, indexes: DataFrame | None = None) -> DataFrame:
    """Totals of one index per row, from one pass over the conversions; ``indexes`` as in ``list_indexes``."""
    kept = ~F.col("skipped")
    per_index = conversions.groupBy("index_name").agg(
        F.count("*").alias("fields_total"),
        F.count_if(kept).alias("fields_converted"),
        F.count_if("skipped").alias("fields_skipped"),
        F.count_if("is_vector").alias("vector_fields"),
        F.count_if(F.col("is_vector") & kept).alias("indexes"),
        (
            F.sum(F.size("type_warnings") + (F.col("confidence") == "lossy").cast("int"))
            + (~F.bool_or("is_primary_key")).cast("int")
        ).alias("_warnings"),
    )
    features = unsupported.groupBy("index_name").agg(F.count("*").alias("unsupported_features"))
    counts = ["fields_total", "fields_converted", "fields_skipped", "vector_fields", "indexes"]
    per_index = _with_fieldless(per_index, indexes, counts).fillna(1, ["_warnings"])  # the missing key
    return (
        per_index.join(features, "index_name", "left")
        .fillna(0, ["unsupported_features"])
        .withColumn("warnings", F.col("_warnings") + F.col("unsupported_features"))
        .withColumn("collection", collection_name(F.col("index_name")))
        .drop("_warnings")
    )


def field_details(conversions: DataFrame) -> DataFrame:
    """Export row of every field."""
    absent = F.lit("N/A")
    return conversions.select(
        "index_name", "field_name", "edm_type",
        F.coalesce("target_type", absent).alias("target_type"),
        F.coalesce("target_name", absent).alias("target_name"),
        "max_length", "dim", "confidence", "is_vector", "is_primary_key", "skipped",
        F.coalesce("renamed_to", F.lit("")).alias("renamed_to"), "notes",
    )


def attribute_flags(fields: DataFrame) -> DataFrame:
    """What every set field attribute turns into."""
    rules = edm.pair_table(fields.sparkSession, edm.ATTRIBUTE_RULES, ("attribute", "handling"))
    flag_columns = {
        "key": F.col("is_key"), "filterable": F.col("filterable"), "sortable": F.col("sortable"),
        "searchable": F.col("searchable"), "facetable": F.col("facetable"), "retrievable": F.lit(True),
    }
    present = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flag_columns.items()]))
    return fields.select("index_name", "field_name", F.explode(present).alias("attribute")).join(
        F.broadcast(rules), "attribute"
    )


def assess(conversions: DataFrame, indexes: DataFrame | None = None, rows_per_index: DataFrame | None = None) -> DataFrame:
    """Field counts and feasibility per index; ``indexes`` as in ``list_indexes``.

    With ``rows_per_index`` (index_name, n_rows) also ``document_count``, null for an index that has no count there.
    """
    kept = ~F.col("skipped")
    counts = conversions.groupBy("index_name").agg(
        F.count("*").alias("total_fields"),
        F.count_if("skipped").alias("skipped_fields"),
        F.count_if(kept & (F.col("confidence") == "lossy")).alias("lossy_fields"),
        F.count_if(kept & (F.col("confidence") != "unsupported")).alias("convertible_fields"),
        F.count_if(kept & (F.col("confidence") == "unsupported")).alias("unsupported_fields"),
        F.count_if("is_vector").alias("vector_fields"),
    )
    counts = _with_fieldless(counts, indexes, [c for c in counts.columns if c != "index_name"])
    if rows_per_index is not None:
        counted = rows_per_index.select("index_name", F.col("n_rows").cast("long").alias("document_count"))
        counts = counts.join(counted, "index_name", "left")
    clean = (F.col("skipped_fields") == 0) & (F.col("lossy_fields") == 0)
    return counts.withColumn(
        "feasibility",
        F.when(clean, "full").when(F.col("convertible_fields") > 0, "partial").otherwise("complex"),
    )


def index_flags(conversions: DataFrame) -> DataFrame:
    return conversions.groupBy("index_name").agg(
        F.bool_or("is_vector").alias("has_vectors"),
        F.bool_or((F.col("edm_type") == "Edm.String") & ~F.col("skipped")).alias("has_text"),
    )


def type_coverage(conversions: DataFrame) -> DataFrame:
    """Fields per source and target type over the whole catalog."""
    return conversions.groupBy(
        "edm_type", F.coalesce("target_type", F.lit("N/A")).alias("target_type")
    ).agg(F.count("*").alias("n_fields"), F.count_if("skipped").alias("n_skipped"))


def confidence_rollup(conversions: DataFrame) -> DataFrame:
    """Fields per index and confidence class with sub-totals (null = all)."""
    return conversions.rollup("index_name", "confidence").agg(F.count("*").alias("n_fields"))


def vector_memory(conversions: DataFrame, rows_per_index: DataFrame) -> DataFrame:
    """Bytes of every vector field before and after loading."""
    source_bits = F.create_map(*[
        F.lit(x) for pair in {
            "Collection(Edm.Single)": 32, "Collection(Edm.Half)": 16, "Collection(Edm.Int16)": 16,
            "Collection(Edm.SByte)": 8, "Collection(Edm.Byte)": 1,
        }.items() for x in pair
    ])
    target_bits = F.create_map(*[
        F.lit(x) for pair in {"FLOAT_VECTOR": 32, "FLOAT16_VECTOR": 16, "BINARY_VECTOR": 1}.items() for x in pair
    ])
    sized = (
        conversions.filter(F.col("is_vector") & F.col("dim").isNotNull())
        .join(rows_per_index, "index_name")
        .withColumn("_values", F.col("n_rows").cast("long") * F.col("dim"))
    )
    return sized.select(
        "index_name", "field_name", "target_type",
        (F.col("_values") * F.try_element_at(source_bits, F.col("edm_type")) / 8).cast("long").alias("source_bytes"),
        (F.col("_values") * F.try_element_at(target_bits, F.col("target_type")) / 8).cast("long").alias("target_bytes"),
    )
