"""Schema-mapping queries over a catalog of index definitions derived from ``part``.

Every 20 consecutive parts form one index definition, so the number of indexes grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecferry.functions import edm
from vecferry.operators import schema_map as sm
from vecferry.plans.tables import table

EDM_NAMES = [t.edm_type for t in edm.SCALAR_TYPES + edm.COLLECTION_TYPES + edm.VECTOR_TYPES] + [
    "Edm.Stream", "Collection(Edm.ComplexType)",
]
KINDS = ["hnsw", "exhaustiveKnn", "hnsw", "futureKind"]
METRIC_NAMES = ["cosine", "euclidean", "dotProduct", "hamming", "chebyshev"]
OVERRIDE_BRANDS = ["Brand#3", "Brand#5", "Brand#6", "Brand#7"]


def _pick(names: list[str], position) -> F.Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (position % len(names) + 1).cast("int"))


def _indexed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    number = F.floor(F.col("p_partkey") / 20).cast("long")
    return parts.withColumn("idx", number).withColumn("index_name", F.concat(F.lit("index-"), number.cast("string")))


def _field_name():
    return F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("_"), (F.col("p_partkey") % 20).cast("string"))


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    edm_type = _pick(EDM_NAMES, F.col("p_partkey"))
    size = F.col("p_size")
    is_vector = F.col("p_partkey") % 23 >= 16
    return _indexed_parts(spark, sf_dir).select(
        "index_name",
        (F.col("p_partkey") % 20).alias("ordinal"),
        _field_name().alias("field_name"),
        edm_type.alias("edm_type"),
        ((F.col("p_partkey") % 20 == 0) & (F.col("idx") % 7 != 3)).alias("is_key"),
        F.when((size % 11 == 0) & ~is_vector, F.lit(2)).otherwise(F.lit(0)).alias("n_subfields"),
        F.when(is_vector, (size % 8 + 1) * 64).alias("dimensions"),
        F.when(is_vector, F.concat(F.lit("profile-"), (size % 4).cast("string"))).alias("profile_name"),
        (size % 2 == 0).alias("filterable"), (size % 3 == 0).alias("sortable"),
        (size % 5 == 0).alias("searchable"), (size % 7 == 0).alias("facetable"),
    )


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.col("p_brand")
    return _indexed_parts(spark, sf_dir).filter(brand.isin(*OVERRIDE_BRANDS)).select(
        "index_name", _field_name().alias("field_name"),
        (brand == "Brand#3").alias("excluded"),
        F.when(brand == "Brand#5", F.concat(_field_name(), F.lit("_renamed"))).alias("target_name"),
        F.when(brand == "Brand#5", F.lit(256)).alias("max_length"),
        F.when(brand == "Brand#6", F.lit(64)).alias("max_capacity"),
        (brand == "Brand#7").alias("is_partition_key"),
    )


def _per_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed_parts(spark, sf_dir).select("index_name", "idx").distinct()


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = _per_index(spark, sf_dir).select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("p"))
    return spread.select(
        "index_name",
        F.concat(F.lit("profile-"), F.col("p").cast("string")).alias("profile_name"),
        F.concat(F.lit("algo-"), ((F.col("idx") + F.col("p")) % 5).cast("string")).alias("algorithm_name"),
    )


def algorithms(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = _per_index(spark, sf_dir).select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("a"))
    position = F.col("idx") + F.col("a")
    declares = F.col("a") != 2
    return spread.select(
        "index_name",
        F.concat(F.lit("algo-"), F.col("a").cast("string")).alias("algorithm_name"),
        _pick(KINDS, F.col("a")).alias("kind"),
        F.when(declares, _pick(METRIC_NAMES, position)).alias("metric"),
        F.when(F.col("a") == 0, (position % 3 * 8 + 8).cast("int")).alias("m"),
        F.when(F.col("a") == 0, F.lit(200)).alias("ef_construction"),
        F.when((F.col("a") == 0) & (F.col("idx") % 2 == 0), F.lit(100)).alias("ef_search"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_index(spark, sf_dir).select(
        "index_name", (F.col("idx") % 3 == 0).alias("has_scoring_profiles"),
        (F.col("idx") % 4 == 0).alias("has_suggesters"), (F.col("idx") % 5 == 0).alias("has_semantic"),
    )


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.convert_fields(fields(spark, sf_dir), overrides(spark, sf_dir))


def rows_per_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per index: the line items of its parts."""
    items = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("index-"), F.floor(F.col("l_partkey") / 20).cast("string")).alias("index_name")
    )
    return items.groupBy("index_name").agg(F.count("*").alias("n_rows"))


def _resolved(spark, sf_dir):
    return sm.resolve_profiles(conversions(spark, sf_dir), profiles(spark, sf_dir), algorithms(spark, sf_dir))


def _unsupported(spark, sf_dir):
    return sm.unsupported_features(features(spark, sf_dir))


def _warnings(spark, sf_dir):
    return sm.schema_warnings(conversions(spark, sf_dir), _unsupported(spark, sf_dir))


def q_resolve_type(spark, sf_dir):
    return sm.resolve_types(fields(spark, sf_dir)).select(
        "index_name", "field_name", "edm_type", "family", "target_type", "confidence", "is_vector",
        "element_type", "default_max_length", F.size("type_warnings").cast("long").alias("n_warnings"),
    )


def q_all_mappings(spark, sf_dir):
    """Every known mapping with the number of catalog fields that use it."""
    used = fields(spark, sf_dir).groupBy("edm_type").agg(F.count("*").alias("n"))
    return (
        edm.type_dimension(spark).join(used, "edm_type", "left")
        .select("edm_type", "family", "target_type", "confidence", "element_type", "default_max_length",
                F.coalesce("n", F.lit(0).cast("long")).alias("n_fields"))
    )


def q_confidence_counts(spark, sf_dir):
    return conversions(spark, sf_dir).groupBy("index_name", "confidence").agg(F.count("*").alias("n_fields"))


def q_map_metric(spark, sf_dir):
    return algorithms(spark, sf_dir).select(
        "index_name", "algorithm_name", "metric", edm.map_metric(F.col("metric")).alias("metric_type")
    )


def q_map_vector_index(spark, sf_dir):
    index = edm.map_vector_index(*[F.col(c) for c in ("kind", "metric", "m", "ef_construction", "ef_search")])
    return algorithms(spark, sf_dir).select("index_name", "algorithm_name", index.alias("i")).select(
        "index_name", "algorithm_name", "i.*"
    )


def q_convert_fields(spark, sf_dir):
    every = conversions(spark, sf_dir).withColumn("warnings", F.array_join(F.array_sort("type_warnings"), "; "))
    return every.drop("type_warnings", "notes", "profile_name")


def q_collection_name(spark, sf_dir):
    named = sm.list_indexes(fields(spark, sf_dir))
    override = F.when(F.col("index_name").endswith("7"), F.concat(F.lit("coll_"), F.col("index_name")))
    return named.select("index_name", sm.collection_name(F.col("index_name"), override).alias("collection"))


def q_schema_warnings(spark, sf_dir):
    return _warnings(spark, sf_dir)


def q_schema_summary(spark, sf_dir):
    return sm.schema_summary(conversions(spark, sf_dir), _unsupported(spark, sf_dir))


def q_complex_fields(spark, sf_dir):
    return sm.complex_fields(fields(spark, sf_dir)).select("index_name", "field_name", "edm_type", "effective_type")


def q_assess_counts(spark, sf_dir):
    return sm.assess(conversions(spark, sf_dir)).drop("feasibility")


def q_feasibility(spark, sf_dir):
    return sm.assess(conversions(spark, sf_dir)).select(
        "index_name", "feasibility", "unsupported_fields",
    )


def q_vector_memory(spark, sf_dir):
    return sm.vector_memory(conversions(spark, sf_dir), rows_per_index(spark, sf_dir))


QUERIES = {
    "resolve_type": q_resolve_type,
    "all_mappings": q_all_mappings,
    "confidence_counts": q_confidence_counts,
    "map_metric": q_map_metric,
    "map_vector_index": q_map_vector_index,
    "resolve_profile": _resolved,
    "convert_fields": q_convert_fields,
    "collection_name": q_collection_name,
    "unsupported_features": _unsupported,
    "schema_warnings": q_schema_warnings,
    "schema_summary": q_schema_summary,
    "complex_fields": q_complex_fields,
    "field_details": lambda s, d: sm.field_details(conversions(s, d)),
    "attribute_flags": lambda s, d: sm.attribute_flags(fields(s, d)),
    "assess_counts": q_assess_counts,
    "feasibility": q_feasibility,
    "index_flags": lambda s, d: sm.index_flags(conversions(s, d)),
    "type_coverage": lambda s, d: sm.type_coverage(conversions(s, d)),
    "confidence_rollup": lambda s, d: sm.confidence_rollup(conversions(s, d)),
    "vector_memory": q_vector_memory,
    "key_fields": lambda s, d: sm.key_fields(fields(s, d)),
    "list_indexes": lambda s, d: sm.list_indexes(fields(s, d)),
}


def _sql(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_sql(v) for v in row) + ")" for row in rows)


_ALL_TYPES = edm.SCALAR_TYPES + edm.COLLECTION_TYPES + edm.VECTOR_TYPES
_LIST = "[" + ", ".join(_sql(n) for n in EDM_NAMES) + "]"

CATALOG_SQL = f"""
typemap(edm_type, family, target_type, confidence, element_type, default_max_length, notes) AS
  (VALUES {_values(tuple(t[:7]) for t in _ALL_TYPES)}),
typewarn(edm_type, message) AS (VALUES {_values((t.edm_type, w) for t in _ALL_TYPES for w in t.warnings)}),
parts AS (
  SELECT *, p_partkey // 20 AS idx, 'index-' || (p_partkey // 20) AS index_name,
         replace(p_name, ' ', '_') || '_' || (p_partkey % 20) AS field_name
  FROM part),
fields AS (
  SELECT index_name, p_partkey % 20 AS ordinal, field_name, {_LIST}[p_partkey % 23 + 1] AS edm_type,
         (p_partkey % 20 = 0 AND idx % 7 <> 3) AS is_key,
         CASE WHEN p_size % 11 = 0 AND p_partkey % 23 < 16 THEN 2 ELSE 0 END AS n_subfields,
         CASE WHEN p_partkey % 23 >= 16 THEN (p_size % 8 + 1) * 64 END AS dimensions,
         CASE WHEN p_partkey % 23 >= 16 THEN 'profile-' || (p_size % 4) END AS profile_name,
         p_size % 2 = 0 AS filterable, p_size % 3 = 0 AS sortable, p_size % 5 = 0 AS searchable,
         p_size % 7 = 0 AS facetable
  FROM parts),
overrides AS (
  SELECT index_name, field_name, p_brand = 'Brand#3' AS excluded,
         CASE WHEN p_brand = 'Brand#5' THEN field_name || '_renamed' END AS new_name,
         CASE WHEN p_brand = 'Brand#5' THEN 256 END AS o_max_length,
         CASE WHEN p_brand = 'Brand#6' THEN 64 END AS o_max_capacity,
         p_brand = 'Brand#7' AS o_partition
  FROM parts WHERE p_brand IN ({", ".join(_sql(b) for b in OVERRIDE_BRANDS)})),
per_index AS (SELECT DISTINCT index_name, idx FROM parts),
profiles AS (
  SELECT index_name, 'profile-' || p AS profile_name, 'algo-' || ((idx + p) % 5) AS algorithm_name
  FROM per_index, range(3) AS r(p)),
algorithms AS (
  SELECT index_name, 'algo-' || a AS algorithm_name, ['hnsw', 'exhaustiveKnn', 'hnsw', 'futureKind'][a + 1] AS kind,
         CASE WHEN a <> 2 THEN ['cosine', 'euclidean', 'dotProduct', 'hamming', 'chebyshev'][(idx + a) % 5 + 1] END
           AS metric,
         CAST(CASE WHEN a = 0 THEN (idx + a) % 3 * 8 + 8 END AS INTEGER) AS m,
         CASE WHEN a = 0 THEN 200 END AS ef_construction,
         CASE WHEN a = 0 AND idx % 2 = 0 THEN 100 END AS ef_search
  FROM per_index, range(4) AS r(a)),
features AS (
  SELECT index_name, 'scoringProfiles' AS feature FROM per_index WHERE idx % 3 = 0 UNION ALL
  SELECT index_name, 'suggesters' FROM per_index WHERE idx % 4 = 0 UNION ALL
  SELECT index_name, 'semanticConfiguration' FROM per_index WHERE idx % 5 = 0),
messages(feature, message) AS (VALUES {_values(edm.UNSUPPORTED_FEATURES.items())}),
unsupported AS (SELECT index_name, feature, message FROM features JOIN messages USING (feature)),
joined AS (
  SELECT f.*, coalesce(o.excluded, false) AS skipped, new_name, o_max_length, o_max_capacity, o_partition,
         CASE WHEN NOT coalesce(o.excluded, false) AND n_subfields > 0 THEN 'Edm.ComplexType' ELSE f.edm_type END AS eff
  FROM fields f LEFT JOIN overrides o USING (index_name, field_name)),
typed AS (
  SELECT j.index_name, j.ordinal, j.field_name, j.eff AS edm_type, j.is_key, j.dimensions, j.profile_name, j.skipped,
         j.new_name, j.o_max_length, j.o_max_capacity, j.o_partition,
         coalesce(t.target_type, 'JSON') AS mapped, coalesce(t.confidence, 'unsupported') AS confidence,
         coalesce(t.family = 'vector', false) AS is_vector, t.element_type AS elem, t.default_max_length AS dml,
         coalesce(t.notes, 'unknown type, kept as JSON') AS notes
  FROM joined j LEFT JOIN typemap t ON t.edm_type = j.eff),
conversions AS (
  SELECT index_name, ordinal, field_name, edm_type,
    CASE WHEN NOT skipped THEN coalesce(new_name, field_name) END AS target_name,
    CASE WHEN NOT skipped THEN CASE WHEN is_key AND mapped NOT IN ('INT64', 'VARCHAR') THEN 'VARCHAR' ELSE mapped END
      END AS target_type,
    CASE WHEN NOT skipped AND mapped = 'ARRAY' THEN elem END AS element_type,
    CASE WHEN NOT skipped THEN
      CASE WHEN mapped = 'VARCHAR' THEN coalesce(o_max_length, dml, 65535)
           WHEN mapped = 'ARRAY' AND elem = 'VARCHAR' THEN coalesce(o_max_length, 65535)
           WHEN is_key AND mapped NOT IN ('INT64', 'VARCHAR') THEN 65535 END END AS max_length,
    CASE WHEN NOT skipped AND mapped = 'ARRAY' THEN coalesce(o_max_capacity, 4096) END AS max_capacity,
    CASE WHEN NOT skipped AND is_vector AND dimensions > 0 THEN dimensions END AS dim,
    confidence, is_vector, (is_key AND NOT skipped) AS is_primary_key,
    (NOT skipped AND coalesce(o_partition, false) AND (is_key OR mapped IN ('INT64', 'VARCHAR'))) AS is_partition_key,
    skipped,
    CASE WHEN NOT skipped AND new_name IS NOT NULL THEN new_name END AS renamed_to,
    notes, profile_name
  FROM typed),
resolved AS (
  SELECT c.index_name, c.field_name, c.target_name,
    CASE WHEN a.kind IS NULL THEN '' ELSE c.profile_name END AS profile_name,
    coalesce(a.kind, 'hnsw') AS algorithm_kind, coalesce(a.metric, 'cosine') AS metric, a.m, a.ef_construction, a.ef_search
  FROM conversions c LEFT JOIN profiles p ON p.index_name = c.index_name AND p.profile_name = c.profile_name
  LEFT JOIN algorithms a ON a.index_name = c.index_name AND a.algorithm_name = p.algorithm_name
  WHERE c.is_vector AND NOT c.skipped),
warnings AS (
  SELECT c.index_name, c.field_name, 'type_mapping' AS category, w.message FROM conversions c JOIN typewarn w USING (edm_type)
  UNION ALL
  SELECT index_name, field_name, 'type_mapping', 'unknown type, stored as JSON' FROM conversions WHERE confidence = 'unsupported'
  UNION ALL
  SELECT index_name, field_name, 'type_lossy', 'field ''' || field_name || ''' (' || edm_type || ') loses precision'
  FROM conversions WHERE confidence = 'lossy'
  UNION ALL
  SELECT index_name, '', 'schema', 'no key field, ids are generated' FROM conversions
  GROUP BY index_name HAVING NOT bool_or(is_primary_key)
  UNION ALL
  SELECT index_name, '', 'unsupported_feature', message FROM unsupported)
"""

_METRIC_CASE = """CASE metric WHEN 'euclidean' THEN 'L2' WHEN 'dotProduct' THEN 'IP' WHEN 'hamming' THEN 'HAMMING'
 ELSE 'COSINE' END"""


def _index_columns(kind: str) -> str:
    return f"""
  CASE WHEN {kind} = 'exhaustiveKnn' THEN 'FLAT' ELSE 'HNSW' END AS index_type, {_METRIC_CASE} AS metric_type,
  CASE WHEN {kind} = 'hnsw' THEN coalesce(m, 4) WHEN {kind} = 'exhaustiveKnn' THEN NULL ELSE 16 END AS param_m,
  CASE WHEN {kind} = 'hnsw' THEN coalesce(ef_construction, 400) WHEN {kind} = 'exhaustiveKnn' THEN NULL ELSE 256 END
    AS param_ef_construction,
  CASE WHEN {kind} = 'hnsw' THEN coalesce(ef_search, 500) WHEN {kind} = 'exhaustiveKnn' THEN NULL ELSE 256 END AS param_ef"""


_ASSESS = """SELECT index_name, count(*) AS total_fields, count(*) FILTER (skipped) AS skipped_fields,
  count(*) FILTER (NOT skipped AND confidence = 'lossy') AS lossy_fields,
  count(*) FILTER (NOT skipped AND confidence <> 'unsupported') AS convertible_fields,
  count(*) FILTER (NOT skipped AND confidence = 'unsupported') AS unsupported_fields,
  count(*) FILTER (is_vector) AS vector_fields
  FROM conversions GROUP BY index_name"""

_BODIES = {
    "resolve_type": """SELECT f.index_name, f.field_name, f.edm_type, coalesce(t.family, 'unknown') AS family,
      coalesce(t.target_type, 'JSON') AS target_type, coalesce(t.confidence, 'unsupported') AS confidence,
      coalesce(t.family = 'vector', false) AS is_vector, t.element_type, t.default_max_length,
      CASE WHEN t.edm_type IS NULL THEN 1 ELSE coalesce(w.n, 0) END AS n_warnings
      FROM fields f LEFT JOIN typemap t USING (edm_type)
      LEFT JOIN (SELECT edm_type, count(*) AS n FROM typewarn GROUP BY 1) w ON w.edm_type = f.edm_type""",
    "all_mappings": """SELECT t.edm_type, family, target_type, confidence, element_type, default_max_length,
      count(f.field_name) AS n_fields FROM typemap t LEFT JOIN fields f ON f.edm_type = t.edm_type
      GROUP BY ALL""",
    "confidence_counts": "SELECT index_name, confidence, count(*) AS n_fields FROM conversions GROUP BY 1, 2",
    "map_metric": f"SELECT index_name, algorithm_name, metric, {_METRIC_CASE} AS metric_type FROM algorithms",
    "map_vector_index": f"SELECT index_name, algorithm_name, {_index_columns('kind')} FROM algorithms",
    "resolve_profile": f"""SELECT index_name, field_name, target_name, profile_name, algorithm_kind, metric,
      {_index_columns('algorithm_kind')} FROM resolved""",
    "convert_fields": """SELECT c.* EXCLUDE (notes, profile_name), CASE WHEN skipped THEN 'excluded by option' END AS skip_reason,
      CASE WHEN confidence = 'unsupported' THEN 'unknown type, stored as JSON' ELSE coalesce(w.said, '') END AS warnings
      FROM conversions c LEFT JOIN (SELECT edm_type, string_agg(message, '; ' ORDER BY message) AS said FROM typewarn GROUP BY 1) w
      ON w.edm_type = c.edm_type""",
    "collection_name": """SELECT DISTINCT index_name, CASE WHEN index_name LIKE '%7' THEN 'coll_' || index_name
      ELSE replace(index_name, '-', '_') END AS collection FROM fields""",
    "unsupported_features": "SELECT index_name, feature, message FROM unsupported",
    "schema_warnings": "SELECT index_name, field_name, category, message FROM warnings",
    "schema_summary": """SELECT c.index_name, replace(c.index_name, '-', '_') AS collection, count(*) AS fields_total,
      count(*) FILTER (NOT skipped) AS fields_converted, count(*) FILTER (skipped) AS fields_skipped,
      count(*) FILTER (is_vector) AS vector_fields,
      (SELECT count(*) FROM resolved r WHERE r.index_name = c.index_name) AS indexes,
      (SELECT count(*) FROM warnings w WHERE w.index_name = c.index_name) AS warnings,
      (SELECT count(*) FROM unsupported u WHERE u.index_name = c.index_name) AS unsupported_features
      FROM conversions c GROUP BY c.index_name""",
    "complex_fields": """SELECT index_name, field_name, edm_type, 'Edm.ComplexType' AS effective_type FROM fields
      WHERE n_subfields > 0""",
    "field_details": """SELECT index_name, field_name, edm_type, coalesce(target_type, 'N/A') AS target_type,
      coalesce(target_name, 'N/A') AS target_name, max_length, dim, confidence, is_vector, is_primary_key, skipped,
      coalesce(renamed_to, '') AS renamed_to, notes FROM conversions""",
    "attribute_flags": f"""SELECT index_name, field_name, attribute, handling FROM (
      SELECT index_name, field_name, 'key' AS attribute FROM fields WHERE is_key UNION ALL
      SELECT index_name, field_name, 'filterable' FROM fields WHERE filterable UNION ALL
      SELECT index_name, field_name, 'sortable' FROM fields WHERE sortable UNION ALL
      SELECT index_name, field_name, 'searchable' FROM fields WHERE searchable UNION ALL
      SELECT index_name, field_name, 'facetable' FROM fields WHERE facetable UNION ALL
      SELECT index_name, field_name, 'retrievable' FROM fields) JOIN
      (VALUES {_values(edm.ATTRIBUTE_RULES.items())}) AS rules(attribute, handling) USING (attribute)""",
    "assess_counts": _ASSESS,
    "feasibility": f"""SELECT index_name, unsupported_fields, CASE WHEN skipped_fields = 0 AND lossy_fields = 0 THEN 'full'
      WHEN convertible_fields > 0 THEN 'partial' ELSE 'complex' END AS feasibility FROM ({_ASSESS})""",
    "index_flags": """SELECT index_name, bool_or(is_vector) AS has_vectors,
      bool_or(edm_type = 'Edm.String' AND NOT skipped) AS has_text FROM conversions GROUP BY index_name""",
    "type_coverage": """SELECT edm_type, coalesce(target_type, 'N/A') AS target_type, count(*) AS n_fields,
      count(*) FILTER (skipped) AS n_skipped FROM conversions GROUP BY 1, 2""",
    "confidence_rollup": """SELECT index_name, confidence, count(*) AS n_fields FROM conversions
      GROUP BY ROLLUP (index_name, confidence)""",
    "vector_memory": """SELECT c.index_name, c.field_name, c.target_type,
      CAST(n * dim * CASE c.edm_type WHEN 'Collection(Edm.Single)' THEN 32 WHEN 'Collection(Edm.Half)' THEN 16
        WHEN 'Collection(Edm.Int16)' THEN 16 WHEN 'Collection(Edm.SByte)' THEN 8 ELSE 1 END // 8 AS BIGINT) AS source_bytes,
      CAST(n * dim * CASE c.target_type WHEN 'FLOAT_VECTOR' THEN 32 WHEN 'FLOAT16_VECTOR' THEN 16 WHEN 'BINARY_VECTOR'
        THEN 1 END // 8 AS BIGINT) AS target_bytes
      FROM conversions c JOIN (SELECT 'index-' || (l_partkey // 20) AS index_name, count(*) AS n FROM lineitem GROUP BY 1) r
      USING (index_name) WHERE c.is_vector AND dim IS NOT NULL""",
    "key_fields": """SELECT index_name, min_by(field_name, ordinal) FILTER (is_key) AS key_field FROM fields
      GROUP BY index_name""",
    "list_indexes": "SELECT DISTINCT index_name FROM fields",
}

ORACLES = {name: f"WITH {CATALOG_SQL} {body}" for name, body in _BODIES.items()}
