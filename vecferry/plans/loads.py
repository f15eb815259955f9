"""Scan, load, batch, check and reconcile queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecferry import workflow
from vecferry.functions import vectors as ve
from vecferry.functions.coerce import FieldSpec
from vecferry.functions.edm import pair_table
from vecferry.operators import batches as ba
from vecferry.operators import checks as ch
from vecferry.operators import digest_tree as dt
from vecferry.operators import reconcile as rec
from vecferry.operators import schema_map as sm
from vecferry.operators import transform as tr
from vecferry.plans import catalog
from vecferry.plans.rows import CUSTOMER_SPECS, DIRTY_SQL, dirty_customer
from vecferry.plans.tables import table
from vecferry.session import work_path
from vecferry.sources import bulk
from vecferry.sources import definitions as de
from vecferry.sources import documents as src
from vecferry.sources import tables as tb
from vecferry.sources import target as tg

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCALARS = ["name", "nation", "balance", "segment"]
BATCH = 500
TABLE_BUCKETS = 8


def documents(spark: SparkSession, sf_dir: str, select: list[str] | None = None) -> DataFrame:
    return src.scan(spark, f"{sf_dir}/documents.parquet", select)


def _vector_rows(spark, sf_dir):
    specs = [
        FieldSpec("vec_id", "id", "INT64", is_key=True), FieldSpec("embedding", "vector", "FLOAT_VECTOR", dim=64),
        FieldSpec("label", "label", "INT32"),
    ]
    return tr.accepted(tr.transform_documents(table(spark, sf_dir, "embeddings"), specs))


def q_scan_index(spark, sf_dir):
    return documents(spark, sf_dir, DOCUMENT_COLUMNS)


def q_scan_select(spark, sf_dir):
    return documents(spark, sf_dir, ["doc_id", "lang"])


def q_scan_json(spark, sf_dir):
    """Documents exported as JSON lines and read back with a declared schema."""
    path = work_path(spark, "json-export")
    exported = documents(spark, sf_dir, DOCUMENT_COLUMNS)
    exported.write.json(path)
    return src.scan(spark, path, DOCUMENT_COLUMNS, exported.schema, "json")


def q_count_source(spark, sf_dir):
    return src.count_documents(documents(spark, sf_dir))


def q_order_by_key(spark, sf_dir):
    return src.ordered_by_key(documents(spark, sf_dir, ["doc_id", "source", "n_chars"]), "doc_id")


def q_sample_target(spark, sf_dir):
    return src.sample(documents(spark, sf_dir, DOCUMENT_COLUMNS), "doc_id")


def q_target_stats(spark, sf_dir):
    return src.table_stats(documents(spark, sf_dir), "doc_id", "text")


def q_payload_size(spark, sf_dir):
    return src.payload_megabytes(documents(spark, sf_dir, DOCUMENT_COLUMNS))


def q_load_append(spark, sf_dir):
    """Two appends of the halves of a table; the stored rows are counted."""
    path = work_path(spark, "append")
    rows = _vector_rows(spark, sf_dir)
    for even in (True, False):
        tg.append(rows.filter((F.col("id") % 2 == 0) == even), path)
    return spark.read.parquet(path).groupBy("label").agg(
        F.count("*").alias("n_rows"), F.sum("id").alias("id_sum"), F.min(F.size("vector")).alias("dim")
    )


def q_bulk_export(spark, sf_dir):
    """Vectors out as bulk-import files, in two writes, and read back from them."""
    path = work_path(spark, "bulk")
    rows = _vector_rows(spark, sf_dir)
    for mode, even in (("overwrite", True), ("append", False)):
        bulk.export(rows.filter((F.col("id") % 2 == 0) == even), path, mode, max_rows=BATCH)
    stored = bulk.read(spark, path)
    return stored.select(
        "id", "label", F.size("vector").alias("dim"), F.element_at("vector", 1).cast("double").alias("first"),
        F.round(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double")), 6).alias("total"))


def q_count_target(spark, sf_dir):
    path = work_path(spark, "target")
    tg.append(_vector_rows(spark, sf_dir), path)
    return src.count_documents(spark.read.parquet(path))


def q_load_outcome(spark, sf_dir):
    path = work_path(spark, "outcome")
    tg.write_outcomes(tr.transform_documents(dirty_customer(spark, sf_dir), CUSTOMER_SPECS), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("outcome", F.col(tr.REASON).alias("reason")).agg(F.count("*").alias("n_rows"))


def q_create_target(spark, sf_dir):
    """Created once, loaded, kept by a second creation, emptied by a dropping one and loaded again."""
    path = work_path(spark, "created")
    rows = tr.accepted(tr.transform_documents(table(spark, sf_dir, "customer"), CUSTOMER_SPECS))
    loaded = []
    for drop in (False, False, True):
        created = tg.create_target(spark, path, CUSTOMER_SPECS, drop_existing=drop)
        if created:
            tg.append(rows, path)
        loaded.append(created)
    stored = spark.read.parquet(path)
    return stored.select(*[s.target for s in CUSTOMER_SPECS], F.lit(",".join(map(str, loaded))).alias("created"))


def q_create_table(spark, sf_dir):
    """By name in the catalog: created, loaded in part, kept by a second creation, and completed by key."""
    name, path = f"customers_{uuid.uuid4().hex}", work_path(spark, "table")
    rows = tr.accepted(tr.transform_documents(table(spark, sf_dir, "customer"), CUSTOMER_SPECS))
    steps = [tb.table_exists(spark, name), tb.create_table(spark, name, CUSTOMER_SPECS, TABLE_BUCKETS, path=path)]
    tb.append_table(rows.filter("id % 3 = 0"), name)
    steps += [tb.table_exists(spark, name), tb.create_table(spark, name, CUSTOMER_SPECS, TABLE_BUCKETS)]
    tb.load_missing(rows, name)
    return spark.table(name).select(*[s.target for s in CUSTOMER_SPECS], F.lit(",".join(map(str, steps))).alias("steps"))


def _saved(rows: DataFrame, key: str) -> DataFrame:
    name = f"saved_{uuid.uuid4().hex}"
    tb.save_table(rows, name, key, TABLE_BUCKETS, work_path(rows.sparkSession, "table"))
    return rows.sparkSession.table(name)


def q_table_reconcile(spark, sf_dir):
    """Two bucketed tables against each other, bucket by bucket."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", *COMPARED)
    return rec.reconcile(_saved(customer, "c_custkey"), _saved(altered_customer(spark, sf_dir).select("c_custkey", *COMPARED), "c_custkey"), "c_custkey", COMPARED)


def q_table_missing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return rec.missing_in_target(_saved(orders, "o_orderkey"), _saved(partial_orders(spark, sf_dir).select("o_orderkey"), "o_orderkey"), "o_orderkey")


def q_load_definitions(spark, sf_dir):
    """The catalog written as JSON index definitions, loaded again and flattened."""
    path = work_path(spark, "definitions")
    de.write_definitions(catalog.fields(spark, sf_dir), path)
    return de.definition_fields(de.load_definitions(spark, path, multi_line=False))


def q_report_fields(spark, sf_dir):
    path = work_path(spark, "reports")
    details = sm.field_details(catalog.conversions(spark, sf_dir))
    tg.write_reports(path, fields=details)
    return spark.read.schema(details.schema).json(f"{path}/fields")


def q_report_indexes(spark, sf_dir):
    path = work_path(spark, "reports")
    resolved = sm.resolve_profiles(
        catalog.conversions(spark, sf_dir), catalog.profiles(spark, sf_dir), catalog.algorithms(spark, sf_dir)
    )
    tg.write_reports(path, indexes=resolved, summary=sm.assess(catalog.conversions(spark, sf_dir)))
    return spark.read.schema(resolved.schema).json(f"{path}/indexes")


def q_report_by_index(spark, sf_dir):
    """A JSON report per index, in parts of eight fields, read back and taken apart."""
    path, fields = work_path(spark, "index-reports"), catalog.conversions(spark, sf_dir)
    resolved = sm.resolve_profiles(fields, catalog.profiles(spark, sf_dir), catalog.algorithms(spark, sf_dir))
    tg.write_index_reports(path, fields, resolved, part_size=8)
    schema = tg.index_reports(fields, resolved).schema
    read = spark.read.schema(schema).json(path)
    return read.groupBy("index_name").agg(
        F.count("*").alias("n_lines"), F.max("n_parts").alias("n_parts"), F.sum(F.size("fields")).alias("n_fields"),
        F.sum(F.size("indexes")).alias("n_indexes"), F.max(F.size("fields")).alias("longest"),
        F.array_join(F.array_sort(F.flatten(F.collect_list("fields.field_name"))), ",").alias("field_names"))


def _numbered_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return ba.number_rows(orders, [F.col("o_orderkey")])


def q_batch_number(spark, sf_dir):
    return _numbered_orders(spark, sf_dir).select("o_orderkey", ba.batch_of(BATCH).alias("batch"))


def q_batch_number_text(spark, sf_dir):
    """The same over a text key."""
    customers = table(spark, sf_dir, "customer").select("c_name")
    return ba.number_rows(customers, [F.col("c_name")]).select("c_name", ba.batch_of(100).alias("batch"))


def q_skip_rows(spark, sf_dir):
    return ba.skip_rows(_numbered_orders(spark, sf_dir), 1000).select("o_orderkey", "o_custkey")


def q_batch_stats(spark, sf_dir):
    return ba.batch_stats(_numbered_orders(spark, sf_dir), BATCH, "o_orderkey").select("batch", "n_rows", "last_key")


def q_running_progress(spark, sf_dir):
    return ba.batch_stats(_numbered_orders(spark, sf_dir), BATCH, "o_orderkey").select("batch", "migrated")


def q_progress_pct(spark, sf_dir):
    total = table(spark, sf_dir, "orders").agg(F.count("*").alias("n")).scalar()
    done = ba.batch_stats(_numbered_orders(spark, sf_dir), BATCH, "o_orderkey").withColumn("total", total)
    pct = F.coalesce(F.try_divide(F.col("migrated") * 100, F.col("total")), F.lit(0.0))
    return done.select("batch", F.round(pct, 4).alias("progress_pct"))


def q_load_totals(spark, sf_dir):
    """Succeeded and failed rows of every upload batch of 100, and the totals so far."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 11 == 0, "{not json").otherwise(F.col("props")).alias("props")
    )
    specs = [FieldSpec("event_id", "id", "INT64", is_key=True), FieldSpec("props", "props", "JSON")]
    flagged = tr.transform_documents(events, specs).select("id", F.col(tr.REASON).isNotNull().alias("bad"))
    per_batch = ba.number_rows(flagged, [F.col("id")]).groupBy(ba.batch_of(100).alias("batch")).agg(
        F.count_if(~F.col("bad")).alias("succeeded"), F.count_if("bad").alias("failed")
    )
    return ba.running_sums(per_batch, "batch", ["succeeded", "failed"])


def partial_orders(spark, sf_dir):
    """The orders a stopped load has written so far: pending ones are still to come."""
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")


def altered_customer(spark, sf_dir):
    """Customer with changed balances, nulled segments, missing rows and extra rows."""
    customer = table(spark, sf_dir, "customer")
    changed = customer.filter(F.col("c_nationkey") != 7).select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_custkey") % 10 == 3, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 10 != 4, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    extra = customer.filter(F.col("c_nationkey") == 9).withColumn("c_custkey", -F.col("c_custkey") - 1)
    return changed.unionByName(extra.select(*changed.columns))


ALTERED_SQL = """altered AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 10 = 3 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_custkey % 10 <> 4 THEN c_mktsegment END AS c_mktsegment FROM customer WHERE c_nationkey <> 7
  UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey = 9)"""
COMPARED = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _plain(checked: DataFrame) -> DataFrame:
    return checked.drop("message")


def q_check_count(spark, sf_dir):
    return ch.check_count(table(spark, sf_dir, "orders"), partial_orders(spark, sf_dir))


def q_check_fields(spark, sf_dir):
    converted = catalog.conversions(spark, sf_dir)
    stored = converted.filter(~F.col("skipped") & ~(F.col("confidence") == "unsupported"))
    return ch.check_field_count(converted, stored.groupBy("index_name").agg(F.count("*").alias("actual")))


def q_fill_rate(spark, sf_dir):
    rows = tr.accepted(tr.transform_documents(dirty_customer(spark, sf_dir), CUSTOMER_SPECS, defaults=False))
    return ch.fill_rates(rows, SCALARS)


def q_check_fill(spark, sf_dir):
    rows = tr.accepted(tr.transform_documents(dirty_customer(spark, sf_dir), CUSTOMER_SPECS, defaults=False))
    return _plain(ch.check_fill_rate(rows, SCALARS))


def q_check_dim(spark, sf_dir):
    ragged = table(spark, sf_dir, "embeddings").select(
        F.when(F.col("label") == 3, F.slice("embedding", 1, 32)).when(F.col("label") != 5, F.col("embedding")).alias("vector")
    )
    with_bits = table(spark, sf_dir, "embeddings").withColumn("bits", ve.sign_bits(F.col("embedding"), 60))
    packed = tr.transform_documents(with_bits, [
        FieldSpec("vec_id", "id", "INT64", is_key=True), FieldSpec("embedding", "half", "FLOAT16_VECTOR", dim=64),
        FieldSpec("bits", "bits", "BINARY_VECTOR", dim=60)])
    parts = [
        ch.check_dimension(_vector_rows(spark, sf_dir), "vector", 64), ch.check_dimension(ragged, "vector", 64),
        ch.check_dimension(packed, "half", 64, "FLOAT16_VECTOR"), ch.check_dimension(packed, "half", 32, "FLOAT16_VECTOR"),
        ch.check_dimension(packed, "bits", 60, "BINARY_VECTOR"),
    ]
    return _plain(reduce(DataFrame.unionByName, parts))


def q_reconcile_values(spark, sf_dir):
    return rec.reconcile(table(spark, sf_dir, "customer"), altered_customer(spark, sf_dir), "c_custkey", COMPARED)


def q_reconcile_digest(spark, sf_dir):
    """Whole texts compared by digest: documents against a copy with some texts cut."""
    docs = documents(spark, sf_dir)
    copy = docs.withColumn("text", F.when(F.col("lang") == "fr", F.rtrim(F.concat("text", F.lit("x")))).otherwise(F.col("text")))
    return rec.reconcile(docs, copy, "doc_id", ["text", "lang", "n_chars"], digest=True)


def q_reconcile_tree(spark, sf_dir):
    """Orders against a copy in which few differ: only leaves of the digest tree that do are joined."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    copy = orders.filter("o_orderkey % 3001 <> 5").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 2003 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    extra = orders.filter("o_orderkey % 4001 = 9").withColumn("o_orderkey", -F.col("o_orderkey"))
    return dt.reconcile_by_digest(
        orders, copy.unionByName(extra), "o_orderkey", ["o_orderstatus", "o_totalprice", "o_orderpriority"])


def q_reconcile_duplicates(spark, sf_dir):
    """A target that a restart has loaded again in part, a third of it with other balances."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", *COMPARED)
    balance = F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") - 1).otherwise(F.col("c_acctbal"))
    again = customer.filter(F.col("c_nationkey") < 5).withColumn("c_acctbal", balance)
    return rec.reconcile(customer, customer.unionByName(again), "c_custkey", COMPARED)


def q_vector_agreement(spark, sf_dir):
    """Stored vectors of which some are scaled, null, cut, gone, extra or stored twice."""
    path = work_path(spark, "vectors")
    label, vector = F.col("label"), F.col("vector")
    scaled = F.transform(vector, lambda x: x * F.lit(5).cast("float"))
    spoilt = _vector_rows(spark, sf_dir).filter(label != 5).withColumn(
        "vector", F.when(label == 1, scaled).when(label == 3, F.slice(vector, 1, 32)).when(label != 4, vector))
    extra = spoilt.filter(label == 2).withColumn("id", -F.col("id") - 1)
    tg.append(spoilt.unionByName(extra).unionByName(spoilt.filter(label == 6)), path)
    source = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return rec.vector_agreement(source, spark.read.parquet(path), "id", "vector")


def q_anti_missing(spark, sf_dir):
    left = rec.missing_in_target(table(spark, sf_dir, "orders"), partial_orders(spark, sf_dir), "o_orderkey")
    return left.select("o_orderkey", "o_custkey")


def q_semi_loaded(spark, sf_dir):
    left = rec.already_loaded(table(spark, sf_dir, "orders"), partial_orders(spark, sf_dir), "o_orderkey")
    return left.select("o_orderkey", "o_custkey")


def _customer_checks(spark, sf_dir):
    customer, altered = table(spark, sf_dir, "customer"), altered_customer(spark, sf_dir)
    differences = rec.reconcile(customer, altered, "c_custkey", COMPARED)
    return _plain(
        ch.check_count(customer, altered)
        .unionByName(ch.check_columns(5, altered))
        .unionByName(ch.check_fill_rate(altered, COMPARED))
        .unionByName(ch.check_dimension(_vector_rows(spark, sf_dir), "vector", 64))
        .unionByName(ch.check_reconciled(differences))
    )


def q_all_checks(spark, sf_dir):
    return _customer_checks(spark, sf_dir)


def q_check_rollup(spark, sf_dir):
    return ch.roll_up(_customer_checks(spark, sf_dir))


CUSTOMER_DEFINITION = {  # field -> source type, in declared order
    "c_custkey": "Edm.Int64", "c_name": "Edm.String", "c_nationkey": "Edm.Int32", "c_acctbal": "Edm.Double",
    "c_mktsegment": "Edm.String",
}


def q_migrate_customer(spark, sf_dir):
    """The whole path: definition, conversion, typed transform, load with rejects, checks of the stored table."""
    names = list(CUSTOMER_DEFINITION)
    declared = pair_table(spark, CUSTOMER_DEFINITION, ("field_name", "edm_type")).select(
        F.lit("customer-index").alias("index_name"), "field_name", "edm_type",
        F.array_position(F.array(*[F.lit(n) for n in names]), F.col("field_name")).alias("ordinal"),
        (F.col("field_name") == "c_custkey").alias("is_key"), F.lit(0).alias("n_subfields"),
        F.lit(None).cast("int").alias("dimensions"), F.lit(None).cast("string").alias("profile_name"),
    )
    renamed = pair_table(spark, {"c_acctbal": "balance"}, ("field_name", "target_name")).select(
        F.lit("customer-index").alias("index_name"), "field_name", "target_name", F.lit(False).alias("excluded"),
        F.lit(None).cast("int").alias("max_length"), F.lit(None).cast("int").alias("max_capacity"),
        F.lit(False).alias("is_partition_key"),
    )
    conversions = sm.convert_fields(declared, renamed)
    source = dirty_customer(spark, sf_dir)
    done = workflow.migrate(source, conversions, "customer-index", work_path(spark, "customer"), defaults=False)
    return _plain(workflow.validate(
        conversions, "customer-index", source, done.stored(spark), defaults=False, tolerance_pct=20.0))


QUERIES = {name.removeprefix("q_"): query for name, query in list(globals().items()) if name.startswith("q_")}

_COUNT_MESSAGE = """SELECT *, expected || ' rows in the source, ' || actual || ' in the target, '
  || format('{:.2f}', abs(expected::BIGINT - actual::BIGINT) * 100.0::DOUBLE / expected::BIGINT) || ' % apart' AS message FROM ("""
_COUNT_CHECK = """SELECT 'document_count' AS name, e = 0 OR abs(e - a) * 100.0 / e <= {tolerance} AS passed,
  e::VARCHAR AS expected, a::VARCHAR AS actual FROM (SELECT (SELECT count(*) FROM {source}) AS e, (SELECT count(*) FROM {target}) AS a)"""


def _fill_check(table_name: str, columns: list[str]) -> str:
    filled = " + ".join(f"count({c})" for c in columns)
    return f"""SELECT 'fill_rate' AS name, 100.0 * ({filled}) / (count(*) * {len(columns)}) > 50 AS passed, '>50%' AS expected,
      round(100.0 * ({filled}) / (count(*) * {len(columns)}), 1)::DOUBLE::VARCHAR || '%' AS actual FROM {table_name}"""


def _reconcile_sql(columns: list[str], source: str, target: str, key: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    least = f"""SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {{table}}
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""
    parts = [
        f"""SELECT '{c}' AS field, count(*) FILTER (s.{key} IS NOT NULL AND t.{key} IS NOT NULL AND s.{c} IS NOT DISTINCT FROM t.{c})
          AS n_match, count(*) FILTER (s.{key} IS NOT NULL AND t.{key} IS NOT NULL AND s.{c} IS DISTINCT FROM t.{c}) AS n_different,
          count(*) FILTER (t.{key} IS NULL) AS n_missing, count(*) FILTER (s.{key} IS NULL) AS n_extra,
          count(*) FILTER (t.n > coalesce(s.n, 1)) AS n_duplicate
          FROM ({least.format(table=source)}) s FULL OUTER JOIN ({least.format(table=target)}) t ON s.{key} = t.{key}"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


_NUMBERED = "numbered AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)"
_ALL_CHECKS = f"""{_COUNT_CHECK.format(tolerance=1, source='customer', target='altered')}
  UNION ALL SELECT 'field_count', true, '5', '5'
  UNION ALL {_fill_check('altered', COMPARED)}
  UNION ALL SELECT 'vector_dim_vector', min(len(embedding)) = 64 AND max(len(embedding)) = 64, '64', min(len(embedding))::VARCHAR
    FROM embeddings
  UNION ALL SELECT 'values', sum(n_different + n_missing + n_extra + n_duplicate) = 0, '0',
    sum(n_different + n_missing + n_extra + n_duplicate)::BIGINT::VARCHAR
    FROM ({_reconcile_sql(COMPARED, 'customer', 'altered', 'c_custkey')})"""

ORACLES = {
    "scan_index": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "scan_select": "SELECT doc_id, lang FROM documents",
    "scan_json": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "count_source": "SELECT count(*) AS n_documents FROM documents",
    "order_by_key": "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id",
    "sample_target": "SELECT doc_id, text, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5",
    "target_stats": """SELECT count(*) AS n_rows, min(doc_id) AS first_key, max(doc_id) AS last_key,
      CAST(sum(octet_length(encode(text))) AS BIGINT) AS text_bytes FROM documents""",
    "payload_size": """SELECT n_bytes, n_bytes / 1048576.0::DOUBLE AS megabytes FROM (SELECT CAST(sum(octet_length(encode(
      to_json({'doc_id': doc_id, 'text': text, 'lang': lang, 'source': source, 'n_chars': n_chars})::VARCHAR))) AS BIGINT)
      AS n_bytes FROM documents)""",
    "bulk_export": """SELECT vec_id AS id, label, len(embedding)::INTEGER AS dim, embedding[1]::DOUBLE AS first,
      round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total FROM embeddings""",
    "load_append": """SELECT label, count(*) AS n_rows, CAST(sum(vec_id) AS BIGINT) AS id_sum,
      CAST(min(len(embedding)) AS INTEGER) AS dim FROM embeddings GROUP BY label""",
    "count_target": "SELECT count(*) AS n_documents FROM embeddings",
    "load_outcome": f"""WITH {DIRTY_SQL} SELECT CASE WHEN c_custkey IS NULL THEN 'rejected' ELSE 'accepted' END AS outcome,
      CASE WHEN c_custkey IS NULL THEN 'missing key c_custkey' END AS reason, count(*) AS n_rows FROM dirty GROUP BY 1, 2""",
    "load_definitions": f"""WITH {catalog.CATALOG_SQL} SELECT index_name, ordinal, field_name, edm_type, is_key, n_subfields,
      dimensions, profile_name, searchable, filterable, sortable, facetable FROM fields""",
    "report_by_index": f"""SELECT index_name, greatest(ceil(nf / 8), ceil(coalesce(ni, 0) / 8))::BIGINT AS n_lines,
      greatest(ceil(nf / 8), ceil(coalesce(ni, 0) / 8))::INTEGER AS n_parts, nf AS n_fields, coalesce(ni, 0) AS n_indexes,
      least(nf, 8)::INTEGER AS longest, field_names
      FROM (SELECT index_name, count(*) AS nf, string_agg(field_name, ',' ORDER BY field_name) AS field_names
        FROM ({catalog.ORACLES["convert_fields"]}) GROUP BY 1)
      LEFT JOIN (SELECT index_name, count(*) AS ni FROM ({catalog.ORACLES["resolve_profile"]}) GROUP BY 1) USING (index_name)""",
    "report_fields": catalog.ORACLES["field_details"],
    "report_indexes": catalog.ORACLES["resolve_profile"],
    "create_target": """SELECT c_custkey AS id, substring(c_name, 1, 12) AS name, CAST(c_nationkey AS SMALLINT) AS nation,
      c_acctbal AS balance, c_mktsegment AS segment, 'True,False,True' AS created FROM customer""",
    "create_table": """SELECT c_custkey AS id, substring(c_name, 1, 12) AS name, CAST(c_nationkey AS SMALLINT) AS nation,
      c_acctbal AS balance, c_mktsegment AS segment, 'False,True,True,False' AS steps FROM customer""",
    "table_reconcile": f"WITH {ALTERED_SQL} {_reconcile_sql(COMPARED, 'customer', 'altered', 'c_custkey')}",
    "table_missing": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'",
    "batch_number": f"WITH {_NUMBERED} SELECT o_orderkey, (rn - 1) // 500 AS batch FROM numbered",
    "batch_number_text": """SELECT c_name, (row_number() OVER (ORDER BY c_name) - 1) // 100 AS batch FROM customer""",
    "skip_rows": f"WITH {_NUMBERED} SELECT o_orderkey, o_custkey FROM numbered WHERE rn > 1000",
    "batch_stats": f"""WITH {_NUMBERED} SELECT (rn - 1) // 500 AS batch, count(*) AS n_rows, max(o_orderkey) AS last_key
      FROM numbered GROUP BY 1""",
    "running_progress": f"""WITH {_NUMBERED}, b AS (SELECT (rn - 1) // 500 AS batch, count(*) AS n FROM numbered GROUP BY 1)
      SELECT batch, CAST(sum(n) OVER (ORDER BY batch) AS BIGINT) AS migrated FROM b""",
    "progress_pct": f"""WITH {_NUMBERED}, b AS (SELECT (rn - 1) // 500 AS batch, count(*) AS n FROM numbered GROUP BY 1)
      SELECT batch, round(sum(n) OVER (ORDER BY batch) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 4) AS progress_pct FROM b""",
    "load_totals": """WITH n AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 100 AS batch FROM events),
      b AS (SELECT batch, count(*) FILTER (event_id % 11 <> 0) AS succeeded, count(*) FILTER (event_id % 11 = 0) AS failed
        FROM n GROUP BY 1)
      SELECT batch, succeeded, failed, CAST(sum(succeeded) OVER (ORDER BY batch) AS BIGINT) AS running_succeeded,
        CAST(sum(failed) OVER (ORDER BY batch) AS BIGINT) AS running_failed FROM b""",
    "check_count": _COUNT_MESSAGE + _COUNT_CHECK.format(
        tolerance=1, source="orders", target="(SELECT * FROM orders WHERE o_orderstatus <> 'P')"
    ) + ")",
    "check_fields": f"""WITH {catalog.CATALOG_SQL} SELECT index_name, count(*) FILTER (NOT skipped) AS expected,
      count(*) FILTER (NOT skipped AND confidence <> 'unsupported') AS actual,
      count(*) FILTER (NOT skipped AND confidence <> 'unsupported') >= count(*) FILTER (NOT skipped) AS passed
      FROM conversions GROUP BY index_name""",
    "fill_rate": f"WITH {DIRTY_SQL} " + " UNION ALL ".join(
        f"""SELECT '{t}' AS field, count({c}) AS filled, count(*) AS checked,
          round(count({c}) * 100.0::DOUBLE / count(*), 6) AS fill_pct FROM dirty WHERE c_custkey IS NOT NULL"""
        for t, c in zip(SCALARS, ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    ),
    "check_fill": f"WITH {DIRTY_SQL} " + _fill_check("(SELECT * FROM dirty WHERE c_custkey IS NOT NULL)", COMPARED),
    "check_dim": """SELECT 'vector_dim_vector' AS name, bool_and(len(embedding) = 64) AS passed, '64' AS expected, '64' AS actual
      FROM embeddings UNION ALL
      SELECT 'vector_dim_vector', bool_and(label <> 3), '64', CASE WHEN bool_or(label = 3) THEN '32..64' ELSE '64' END
      FROM embeddings WHERE label <> 5
      UNION ALL SELECT 'vector_dim_half', bool_and(2 * len(embedding) = 128), '128', (2 * max(len(embedding)))::VARCHAR FROM embeddings
      UNION ALL SELECT 'vector_dim_half', bool_and(2 * len(embedding) = 64), '64', (2 * max(len(embedding)))::VARCHAR FROM embeddings
      UNION ALL SELECT 'vector_dim_bits', bool_and(ceil(60 / 8) = 8), '8', '8' FROM embeddings""",
    "reconcile_tree": """WITH copy AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2003 = 7 THEN o_totalprice + 1
      ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 3001 <> 5
      UNION ALL SELECT -o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 4001 = 9) """
      + _reconcile_sql(["o_orderstatus", "o_totalprice", "o_orderpriority"], "orders", "copy", "o_orderkey"),
    "reconcile_duplicates": """WITH again AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL
      SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal - 1 ELSE c_acctbal END, c_mktsegment
      FROM customer WHERE c_nationkey < 5) """ + _reconcile_sql(COMPARED, "customer", "again", "c_custkey"),
    "reconcile_values": f"WITH {ALTERED_SQL} {_reconcile_sql(COMPARED, 'customer', 'altered', 'c_custkey')}",
    "reconcile_digest": """WITH copy AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN text || 'x' ELSE text END AS text, lang, n_chars
      FROM documents) """ + _reconcile_sql(["text", "lang", "n_chars"], "documents", "copy", "doc_id"),
    "vector_agreement": """WITH stored AS (SELECT vec_id AS id, CASE WHEN label = 1 THEN [x * 5::FLOAT FOR x IN embedding]
        WHEN label = 3 THEN embedding[1:32] WHEN label <> 4 THEN embedding END AS t, CASE WHEN label = 6 THEN 2 ELSE 1 END AS n
        FROM embeddings WHERE label <> 5 UNION ALL SELECT -vec_id - 1, embedding, 1 FROM embeddings WHERE label = 2),
      pairs AS (SELECT e.vec_id, stored.id, n, embedding::DOUBLE[] AS s, t::DOUBLE[] AS t,
        coalesce(len(embedding) = len(t), false) AS alike FROM embeddings e FULL OUTER JOIN stored ON e.vec_id = stored.id)
      SELECT count(*) FILTER (alike) AS n_compared,
        count(*) FILTER (alike AND CASE WHEN alike THEN list_distance(s, t) > 1e-6 END) AS n_apart,
        count(*) FILTER (id IS NULL) AS n_missing, count(*) FILTER (vec_id IS NULL) AS n_extra, count(*) FILTER (n > 1) AS n_duplicate,
        count(*) FILTER (vec_id IS NOT NULL AND id IS NOT NULL AND (s IS NULL) <> (t IS NULL)) AS n_null,
        count(*) FILTER (s IS NOT NULL AND t IS NOT NULL AND len(s) <> len(t)) AS n_other_length,
        round(min(CASE WHEN alike THEN list_cosine_similarity(s, t) END), 6) AS lowest FROM pairs""",
    "anti_missing": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'",
    "semi_loaded": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P'",
    "all_checks": f"WITH {ALTERED_SQL} {_ALL_CHECKS}",
    "check_rollup": f"""WITH {ALTERED_SQL}, checks AS ({_ALL_CHECKS}) SELECT bool_and(passed) AS all_passed,
      count(*) FILTER (passed) AS n_passed, count(*) FILTER (NOT passed) AS n_failed,
      '[' || CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END || '] ' || count(*) FILTER (passed) || '/' || count(*)
      || ' checks passed' AS summary FROM checks""",
    "migrate_customer": f"""WITH {DIRTY_SQL}, stored AS (SELECT * FROM dirty WHERE c_custkey IS NOT NULL)
      {_COUNT_CHECK.format(tolerance=20, source='dirty', target='stored')}
      UNION ALL SELECT 'field_count', count(*) >= 5, '5', count(*)::VARCHAR FROM (SELECT unnest(['c_custkey', {', '.join(map(repr, COMPARED))}]))
      UNION ALL {_fill_check('stored', ['c_custkey'] + COMPARED)}
      UNION ALL SELECT 'values', sum(n_different + n_missing + n_extra + n_duplicate) = 0, '0',
        sum(n_different + n_missing + n_extra + n_duplicate)::BIGINT::VARCHAR
        FROM ({_reconcile_sql(COMPARED, '(SELECT * FROM dirty WHERE c_custkey IS NOT NULL)', 'stored', 'c_custkey')})""",
}
