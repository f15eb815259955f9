"""Row-transform queries. Nulls and bad values are derived, as the given tables hold none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.functions import coerce as co
from vecferry.functions import vectors as ve
from vecferry.functions import variants as va
from vecferry.functions.coerce import FieldSpec
from vecferry.operators import transform as tr
from vecferry.plans.tables import table
from vecferry.session import work_path

CUSTOMER_SPECS = [
    FieldSpec("c_custkey", "id", "INT64", is_key=True),
    FieldSpec("c_name", "name", "VARCHAR", max_length=12),
    FieldSpec("c_nationkey", "nation", "INT16"),
    FieldSpec("c_acctbal", "balance", "DOUBLE"),
    FieldSpec("c_mktsegment", "segment", "VARCHAR", max_length=65_535),
]


def _unless(column: str, divisor: int):
    return F.when(F.col("c_custkey") % divisor != 0, F.col(column)).alias(column)


def dirty_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _unless("c_custkey", 7), _unless("c_name", 5), _unless("c_nationkey", 3), _unless("c_acctbal", 4),
        _unless("c_mktsegment", 2),
    )


DIRTY_SQL = """dirty AS (SELECT
  CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS c_name,
  CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS c_nationkey,
  CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 2 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer)"""


def tagged_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").withColumn("tags", F.split("p_name", " "))


def _one(documents: DataFrame, keep: list, **fields) -> DataFrame:
    """Transform single fields next to kept key columns."""
    specs = [FieldSpec(source, target, kind, **extra) for target, (source, kind, extra) in fields.items()]
    kept = [FieldSpec(c, c, "INT64") if t == "bigint" else FieldSpec(c, c, "INT32") for c, t in keep]
    return tr.transform_documents(documents, kept + specs, defaults=False)


def q_transform_docs(spark, sf_dir):
    return tr.accepted(tr.transform_documents(table(spark, sf_dir, "customer"), CUSTOMER_SPECS))


def q_drop_missing_key(spark, sf_dir):
    return tr.rejected(tr.transform_documents(dirty_customer(spark, sf_dir), CUSTOMER_SPECS)).select(
        "name", "balance", F.col(tr.REASON).alias("reason")
    )


def q_null_defaults(spark, sf_dir):
    return tr.accepted(tr.transform_documents(dirty_customer(spark, sf_dir), CUSTOMER_SPECS))


def q_default_values(spark, sf_dir):
    mixed = [
        FieldSpec(s.source, s.target, s.target_type, max_length=s.max_length, is_key=s.is_key,
                  nullable=s.target in ("name", "balance"))
        for s in CUSTOMER_SPECS
    ]
    return tr.accepted(tr.transform_documents(dirty_customer(spark, sf_dir), mixed))


def q_null_vectors(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 != 0, F.col("embedding")).alias("embedding")
    )
    specs = [FieldSpec("vec_id", "id", "INT64", is_key=True), FieldSpec("embedding", "vector", "FLOAT_VECTOR", dim=64)]
    return tr.accepted(tr.transform_documents(rows, specs)).select(
        "id", F.col("vector").isNull().alias("is_absent"),
        F.round(ve.norm(F.col("vector")), 6).alias("norm"),
    )


def q_coerce_varchar(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("open", F.col("o_orderstatus") == "O")
    return tr.accepted(_one(
        orders, [("o_orderkey", "bigint")], key_text=("o_orderkey", "VARCHAR", {}),
        price_text=("o_totalprice", "VARCHAR", {}), open_text=("open", "VARCHAR", {}),
    ))


def q_truncate_varchar(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return tr.accepted(_one(docs, [("doc_id", "bigint")], text=("text", "VARCHAR", {"max_length": 1000})))


def q_coerce_int(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
        F.col("l_partkey").cast("string").alias("part_text"),
        F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")).otherwise(F.lit(" 42 ")).alias("flag_text"),
    )
    out = _one(
        items, [("l_orderkey", "bigint"), ("l_linenumber", "int")],
        price=("l_extendedprice", "INT32", {}), quantity=("l_quantity", "INT16", {}),
        part=("part_text", "INT64", {}), tiny_price=("l_extendedprice", "INT8", {}), flag=("flag_text", "INT32", {}),
    )
    return out.withColumnRenamed(tr.REASON, "reason")


def q_coerce_float(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_discount").cast("string").alias("discount_text"), "l_partkey"
    )
    return tr.accepted(_one(
        items, [("l_orderkey", "bigint"), ("l_linenumber", "int")], discount=("discount_text", "DOUBLE", {}),
        discount_single=("discount_text", "FLOAT", {}), part=("l_partkey", "DOUBLE", {}),
    ))


def q_coerce_bool(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(
        "doc_id", "quality", F.when(F.col("toxic") == 1, "").otherwise("false").alias("text"),
        F.array_repeat("quality", F.col("toxic")).alias("list"),
    )
    return tr.accepted(_one(
        rows, [("doc_id", "bigint")], from_number=("quality", "BOOL", {}), from_text=("text", "BOOL", {}),
        from_list=("list", "BOOL", {}),
    ))


def q_coerce_json(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 11 == 0, "{not json").otherwise(F.col("props")).alias("props"), "value"
    )
    out = _one(events, [("event_id", "bigint")], props=("props", "JSON", {}), wrapped=("value", "JSON", {}))
    return out.select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.get_json_object("wrapped", "$.value").cast("double").alias("wrapped_value"),
        F.col(tr.REASON).alias("reason"),
    )


def q_coerce_array(spark, sf_dir):
    parts = tagged_part(spark, sf_dir).select(
        "p_partkey", "tags", F.array(F.col("p_size").cast("string"), F.lit("7")).alias("good"),
        F.when(F.col("p_size") > 25, F.array(F.col("p_brand"))).alias("bad"),
        F.array("p_size", F.lit(None)).alias("with_null"),
    )
    out = _one(
        parts, [("p_partkey", "bigint")], tags=("tags", "ARRAY", {"element_type": "VARCHAR"}),
        good=("good", "ARRAY", {"element_type": "INT32"}), bad=("bad", "ARRAY", {"element_type": "INT64"}),
        with_null=("with_null", "ARRAY", {"element_type": "VARCHAR"}),
    )
    return out.select(
        "p_partkey", F.array_join("tags", "|").alias("tags"),
        F.aggregate("good", F.lit(0), lambda s, x: s + x).alias("good_sum"),
        F.array_join("with_null", "|", "null").alias("with_null"), F.col(tr.REASON).alias("reason"),
    )


def q_wrap_array(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return tr.accepted(_one(
        parts, [("p_partkey", "bigint")], brands=("p_brand", "ARRAY", {"element_type": "VARCHAR"}),
        sizes=("p_size", "ARRAY", {"element_type": "INT64"}),
    )).select("p_partkey", F.array_join("brands", "|").alias("brands"), F.size("sizes").cast("long").alias("n_sizes"),
              F.element_at("sizes", 1).alias("first_size"))


def q_coerce_float_vector(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("wide"),
        F.encode(F.concat(F.lit("vec-"), F.col("vec_id").cast("string")), "UTF-8").alias("raw"),
    )
    out = tr.accepted(_one(
        rows, [("vec_id", "bigint")], vector=("wide", "FLOAT_VECTOR", {"dim": 64}), from_bytes=("raw", "FLOAT_VECTOR", {}),
    ))
    return out.select(
        "vec_id", F.round(ve.dot(F.col("vector"), F.col("vector")), 6).alias("square"),
        F.element_at("vector", 1).alias("first"), F.element_at("vector", -1).alias("last"),
        F.array_join(F.transform("from_bytes", lambda x: x.cast("int").cast("string")), ",").alias("byte_values"),
    )


def q_upcast_vector(spark, sf_dir):
    quantised = F.transform("embedding", lambda x: F.floor(x.cast("double") * 127 + 0.5).cast("tinyint"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", quantised.alias("q"))
    out = tr.accepted(_one(rows, [("vec_id", "bigint")], vector=("q", "FLOAT_VECTOR", {"dim": 64})))
    return out.select("vec_id", F.posexplode("vector").alias("pos", "element"))


def q_pack_float16(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    out = tr.accepted(_one(rows, [("vec_id", "bigint")], packed=("embedding", "FLOAT16_VECTOR", {"dim": 64})))

    def byte(position):
        return F.conv(F.hex(F.substring("packed", position, F.lit(1))), 16, 10).cast("long")

    codes = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: byte(i * 2 + 1) + byte(i * 2 + 2) * 256)
    return out.select(
        "vec_id", F.octet_length("packed").cast("long").alias("n_bytes"), F.array_join(codes, ",").alias("half_codes")
    )


def packed_signs(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", ve.sign_bits(F.col("embedding"), 64).alias("bits"), "label")
    specs = [
        FieldSpec("vec_id", "vec_id", "INT64"), FieldSpec("bits", "packed", "BINARY_VECTOR"),
        FieldSpec("label", "label", "INT32"),
    ]
    return tr.accepted(tr.transform_documents(rows, specs, defaults=False))


def q_pack_binary(spark, sf_dir):
    return packed_signs(spark, sf_dir).select("vec_id", F.hex("packed").alias("packed_hex"))


def q_datetime_iso(spark, sf_dir):
    return tr.accepted(_one(
        table(spark, sf_dir, "events"), [("event_id", "bigint")], at=("ts", "VARCHAR", {"max_length": 64}),
    ))


def q_geo_json(spark, sf_dir):
    point = F.struct(
        F.lit("Point").alias("type"),
        F.array(F.col("c_nationkey") * 7.5 - 90, F.col("c_nationkey") * 1.25 + 20).alias("coordinates"),
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", point.alias("location"))
    out = tr.accepted(_one(rows, [("c_custkey", "bigint")], location=("location", "JSON", {})))
    return out.select(
        "c_custkey", F.get_json_object("location", "$.type").alias("type"),
        F.get_json_object("location", "$.coordinates[0]").cast("double").alias("lon"),
        F.get_json_object("location", "$.coordinates[1]").cast("double").alias("lat"),
    )


def q_complex_json(spark, sf_dir):
    nested = F.struct(
        F.col("o_orderstatus").alias("status"), F.struct(F.col("o_orderpriority").alias("priority")).alias("detail"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("customer"),
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", nested.alias("nested"))
    out = tr.accepted(_one(rows, [("o_orderkey", "bigint")], doc=("nested", "JSON", {})))
    return out.select(
        "o_orderkey", F.get_json_object("doc", "$.status").alias("status"),
        F.get_json_object("doc", "$.detail.priority").alias("priority"),
        F.get_json_object("doc", "$.customer").cast("long").alias("customer"),
        F.col("doc").contains('"customer":null').alias("keeps_null"),
    )


def q_unknown_json(spark, sf_dir):
    out = _one(
        table(spark, sf_dir, "events"), [("event_id", "bigint")], number=("user_id", "JSON", {}),
        word=("event_type", "JSON", {"wrap_text": True}),
    )
    return out.select(
        "event_id", F.get_json_object("number", "$.value").cast("long").alias("number"),
        F.get_json_object("word", "$.value").alias("word"), F.col(tr.REASON).alias("reason"),
    )


def q_transform_batch(spark, sf_dir):
    out = tr.transform_documents(dirty_customer(spark, sf_dir), CUSTOMER_SPECS)
    return out.groupBy(F.coalesce(F.col(tr.REASON), F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("n_rows"), F.round(F.sum("balance"), 2).alias("balance"),
        F.sum(F.length("name")).alias("name_chars"),
    )


def q_dry_run(spark, sf_dir):
    return tr.transform_counts(tr.transform_documents(dirty_customer(spark, sf_dir), CUSTOMER_SPECS))


def q_dynamic_fields(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("@score", F.lit(1.0))
    specs = [FieldSpec("event_id", "id", "INT64", is_key=True)]
    out = tr.accepted(tr.transform_documents(events, specs, keep_dynamic=True))
    meta = F.col("`$meta`")
    return out.select(
        "id", F.get_json_object(meta, "$.event_type").alias("event_type"),
        F.get_json_object(meta, "$.user_id").cast("long").alias("user_id"),
        F.get_json_object(meta, "$.event_id").isNull().alias("declared_left_out"),
        meta.contains("@score").alias("has_metadata"),
    )


def q_dynamic_variant(spark, sf_dir):
    """Undeclared fields kept as a Variant, stored, and read by path with their types."""
    path = work_path(spark, "dynamic")
    events = table(spark, sf_dir, "events").withColumn("@score", F.lit(1.0))
    specs = [FieldSpec("event_id", "id", "INT64", is_key=True)]
    tr.accepted(tr.transform_documents(events, specs, keep_dynamic="variant")).withColumnRenamed("$meta", "meta").write.parquet(path)
    return spark.read.parquet(path).select(
        "id", va.at("meta", "$.event_type").alias("event_type"), va.at("meta", "$.user_id", "long").alias("user_id"),
        va.at("meta", "$.event_id").isNull().alias("declared_left_out"), va.at("meta", "$['@score']", "double").isNotNull().alias("has_metadata"))


def q_strip_meta(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("@search.score", F.lit(1.0)).withColumn("@odata.etag", F.lit("x"))
    return tr.strip_metadata(events).select(
        "event_id", "user_id", "event_type", "value", "props", co.iso_text(F.col("ts"), T.TimestampNTZType()).alias("ts")
    )


def q_normalize_vector(spark, sf_dir):
    stretched = F.transform("embedding", lambda x: x.cast("double") * 3)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", stretched.alias("v"))
    return rows.select("vec_id", F.posexplode(ve.normalize(F.col("v"))).alias("pos", "element"))


def q_array_limits(spark, sf_dir):
    return tr.array_limits(tagged_part(spark, sf_dir), "p_partkey", "tags", 1, 5)


QUERIES = {name.removeprefix("q_"): query for name, query in list(globals().items()) if name.startswith("q_")}

ORACLES = {
    "transform_docs": """SELECT c_custkey AS id, substring(c_name, 1, 12) AS name, CAST(c_nationkey AS SMALLINT) AS nation,
      c_acctbal AS balance, c_mktsegment AS segment FROM customer""",
    "drop_missing_key": f"""WITH {DIRTY_SQL} SELECT substring(coalesce(c_name, ''), 1, 12) AS name,
      coalesce(c_acctbal, 0) AS balance, 'missing key c_custkey' AS reason FROM dirty WHERE c_custkey IS NULL""",
    "null_defaults": f"""WITH {DIRTY_SQL} SELECT c_custkey AS id, substring(coalesce(c_name, ''), 1, 12) AS name,
      CAST(coalesce(c_nationkey, 0) AS SMALLINT) AS nation, coalesce(c_acctbal, 0) AS balance,
      coalesce(c_mktsegment, '') AS segment FROM dirty WHERE c_custkey IS NOT NULL""",
    "default_values": f"""WITH {DIRTY_SQL} SELECT c_custkey AS id, substring(c_name, 1, 12) AS name,
      CAST(coalesce(c_nationkey, 0) AS SMALLINT) AS nation, c_acctbal AS balance,
      coalesce(c_mktsegment, '') AS segment FROM dirty WHERE c_custkey IS NOT NULL""",
    "null_vectors": """SELECT vec_id AS id, vec_id % 7 = 0 AS is_absent, CASE WHEN vec_id % 7 <> 0 THEN
      round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) END AS norm FROM embeddings""",
    "coerce_varchar": """SELECT o_orderkey, o_orderkey::VARCHAR AS key_text, o_totalprice::VARCHAR AS price_text,
      (o_orderstatus = 'O')::VARCHAR AS open_text FROM orders""",
    "truncate_varchar": "SELECT doc_id, substring(text, 1, 1000) AS text FROM documents",
    "coerce_int": """SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS price,
      CAST(trunc(l_quantity) AS SMALLINT) AS quantity, l_partkey AS part,
      CASE WHEN trunc(l_extendedprice) <= 127 THEN CAST(trunc(l_extendedprice) AS TINYINT) END AS tiny_price,
      CASE WHEN l_returnflag <> 'R' THEN 42 END AS flag,
      nullif(concat_ws('; ', CASE WHEN trunc(l_extendedprice) > 127 THEN 'bad value in l_extendedprice' END,
        CASE WHEN l_returnflag = 'R' THEN 'bad value in flag_text' END), '') AS reason FROM lineitem""",
    "coerce_float": """SELECT l_orderkey, l_linenumber, l_discount AS discount, l_discount::FLOAT AS discount_single,
      l_partkey::DOUBLE AS part FROM lineitem""",
    "coerce_bool": """SELECT doc_id, quality <> 0 AS from_number, toxic <> 1 AS from_text, toxic > 0 AS from_list
      FROM labels""",
    "coerce_json": """SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER)
      END AS k, value AS wrapped_value, CASE WHEN event_id % 11 = 0 THEN 'bad value in props' END AS reason FROM events""",
    "coerce_array": """SELECT p_partkey, replace(p_name, ' ', '|') AS tags, p_size + 7 AS good_sum,
      p_size || '|null' AS with_null, CASE WHEN p_size > 25 THEN 'bad value in bad' END AS reason FROM part""",
    "wrap_array": """SELECT p_partkey, p_brand AS brands, 1::BIGINT AS n_sizes, p_size::BIGINT AS first_size FROM part""",
    "coerce_float_vector": """SELECT vec_id, round(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]), 6) AS square,
      embedding[1] AS first, embedding[-1] AS last,
      array_to_string([ord(c) for c in string_split('vec-' || vec_id, '')], ',') AS byte_values FROM embeddings""",
    "upcast_vector": """SELECT vec_id, CAST(p - 1 AS INTEGER) AS pos, floor(embedding[p]::DOUBLE * 127 + 0.5)::FLOAT AS element
      FROM embeddings, range(1, 65) AS r(p)""",
    "pack_float16": """WITH halves AS (SELECT vec_id, p, embedding[p]::DOUBLE AS x FROM embeddings, range(1, 65) AS r(p)),
      codes AS (SELECT vec_id, p, (CASE WHEN x < 0 THEN 32768 ELSE 0 END + CASE
        WHEN abs(x) < pow(2, -14) THEN round_even(abs(x) * pow(2, 24), 0)
        ELSE (floor(log2(abs(x))) + 14) * 1024 + round_even(abs(x) * pow(2, 10 - floor(log2(abs(x)))), 0) END)::BIGINT AS code
        FROM halves)
      SELECT vec_id, 128::BIGINT AS n_bytes, string_agg(code::VARCHAR, ',' ORDER BY p) AS half_codes FROM codes
      GROUP BY vec_id""",
    "pack_binary": """WITH bytes AS (SELECT vec_id, b, sum(CASE WHEN embedding[b * 8 + j + 1] > 0 THEN pow(2, 7 - j)::INT
        ELSE 0 END)::INT AS byte FROM embeddings, range(8) AS r(b), range(8) AS s(j) GROUP BY ALL)
      SELECT vec_id, string_agg(format('{:02X}', byte), '' ORDER BY b) AS packed_hex FROM bytes GROUP BY vec_id""",
    "datetime_iso": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at FROM events",
    "geo_json": """SELECT c_custkey, 'Point' AS type, c_nationkey::DOUBLE * 7.5 - 90 AS lon,
      c_nationkey::DOUBLE * 1.25 + 20 AS lat FROM customer""",
    "complex_json": """SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority,
      CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS customer, o_orderkey % 2 <> 0 AS keeps_null FROM orders""",
    "unknown_json": "SELECT event_id, user_id AS number, event_type AS word, NULL::VARCHAR AS reason FROM events",
    "transform_batch": f"""WITH {DIRTY_SQL} SELECT CASE WHEN c_custkey IS NULL THEN 'missing key c_custkey' ELSE 'accepted'
      END AS outcome, count(*) AS n_rows, round(sum(coalesce(c_acctbal, 0)), 2) AS balance,
      CAST(sum(length(substring(coalesce(c_name, ''), 1, 12))) AS BIGINT) AS name_chars FROM dirty GROUP BY 1""",
    "dry_run": f"""WITH {DIRTY_SQL} SELECT count(*) AS total, count(c_custkey) AS accepted,
      count(*) - count(c_custkey) AS rejected FROM dirty""",
    "dynamic_fields": """SELECT event_id AS id, event_type, user_id, true AS declared_left_out, false AS has_metadata
      FROM events""",
    "dynamic_variant": """SELECT event_id AS id, event_type, user_id, true AS declared_left_out, false AS has_metadata
      FROM events""",
    "strip_meta": """SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts
      FROM events""",
    "normalize_vector": """WITH s AS (SELECT vec_id, [x::DOUBLE * 3 for x in embedding] AS v FROM embeddings)
      SELECT vec_id, CAST(p - 1 AS INTEGER) AS pos, round(v[p] / sqrt(list_inner_product(v, v)), 6) AS element
      FROM s, range(1, 65) AS r(p)""",
    "array_limits": """WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS tags FROM part)
      SELECT p_partkey, len(tags)::INTEGER AS n_elements, len(tags) > 1 AS over_capacity,
        len([x for x in tags if length(x) > 5]) > 0 AS over_length FROM t
      WHERE len(tags) > 1 OR len([x for x in tags if length(x) > 5]) > 0""",
}
