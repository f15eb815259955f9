"""Filter and facet queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.functions import predicates as pr
from vecferry.functions.coerce import FieldSpec, iso_text
from vecferry.functions import variants as va
from vecferry.operators import facets
from vecferry.plans.rows import tagged_part
from vecferry.plans.tables import spread, table
from vecferry.session import work_path
from vecferry.sources import documents as src
from vecferry.sources import target as tg

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _orders(condition):
    return lambda spark, sf_dir: table(spark, sf_dir, "orders").filter(condition()).select(*ORDER_COLUMNS)


def _orders_sql(condition: str) -> str:
    return f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders WHERE {condition}"


def q_f_bool(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").withColumn("is_good", F.col("quality") == 1)
    return rows.filter(pr.is_true("is_good")).select("doc_id", "toxic")


def q_f_any(spark, sf_dir):
    return tagged_part(spark, sf_dir).filter(pr.any_equals("tags", "red")).select("p_partkey", "p_name")


def q_f_nested_any(spark, sf_dir):
    """Parts with a tag that is long and starts with a given letter, over nested tag records."""
    nested = F.transform("tags", lambda t: F.struct(t.alias("name"), F.length(t).alias("size")))
    parts = tagged_part(spark, sf_dir).withColumn("nested", nested)
    found = parts.filter(pr.any_match("nested", lambda t: (t["size"] >= 5) & t["name"].startswith("g")))
    return found.select("p_partkey", "p_name")


def q_f_json_path(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.filter(pr.json_path("props", "$.k", "int") > 50).select("event_id", "props")


def q_f_variant_path(spark, sf_dir):
    """The same over properties that are stored as Variant, parsed once."""
    path = work_path(spark, "variants")
    table(spark, sf_dir, "events").select("event_id", "props", va.parsed("props").alias("parsed")).write.parquet(path)
    return spark.read.parquet(path).filter(va.at("parsed", "$.k", "int") > 50).select("event_id", "props")


def q_f_date_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("at", iso_text(F.col("o_orderdate"), T.TimestampNTZType()))
    return orders.filter(
        pr.date_text_between("at", "1997-01-01T00:00:00.000000Z", "1998-06-30T23:59:59.999999Z")
    ).select("o_orderkey", "at")


def q_f_date_typed(spark, sf_dir):
    """The same range over the typed column: the comparison reaches the scan."""
    orders = table(spark, sf_dir, "orders").filter(
        pr.date_between("o_orderdate", "1997-01-01T00:00:00", "1998-06-30T23:59:59.999999"))
    return orders.select("o_orderkey", iso_text(F.col("o_orderdate"), T.TimestampNTZType()).alias("at"))


def q_f_prefix(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(pr.prefix("p_name", "bl")).select("p_partkey", "p_name")


def q_f_text(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars"), "doc_id")
    found = docs.filter(pr.has_word("text", "the"))
    return found.orderBy("doc_id").limit(3).select("doc_id", "lang", "n_chars")


def q_match_all(spark, sf_dir):
    return src.scan(spark, f"{sf_dir}/documents.parquet", ["doc_id", "lang", "source", "n_chars"])


def q_f_tenant(spark, sf_dir):
    """One tenant of a table laid out by hash bucket; only the tenant's bucket is read."""
    path = work_path(spark, "tenants")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    layout = tg.write_partitioned(rows, path, FieldSpec("source", "source", "VARCHAR"), buckets=8)
    tenant = "src3"
    stored = spark.read.parquet(path)
    in_bucket = F.col(layout) == tg.hash_bucket(F.lit(tenant), 8)
    return stored.filter(in_bucket & (F.col("source") == tenant)).select("doc_id", "source", "lang", "n_chars")


def q_partition_key(spark, sf_dir):
    path = work_path(spark, "by-lang")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    tg.write_partitioned(rows, path, FieldSpec("lang", "lang", "VARCHAR"))
    stored = spark.read.parquet(path)
    return stored.groupBy("lang").agg(F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_chars"))


def q_facet_counts(spark, sf_dir):
    return facets.facet_counts(table(spark, sf_dir, "documents"), "lang")


def q_facet_tags(spark, sf_dir):
    return facets.array_facet_counts(tagged_part(spark, sf_dir), "tags")


def q_facets_all(spark, sf_dir):
    """All facets of the parts in one pass: what a definition would mark as facetable, an array among it."""
    return facets.all_facets(tagged_part(spark, sf_dir), ["p_brand", "p_size", "tags"])


def q_sort_field(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey")


QUERIES = {
    "f_eq": _orders(lambda: pr.compare("o_orderstatus", "eq", "F")),
    "f_ne": _orders(lambda: pr.compare("o_orderstatus", "ne", "F")),
    "f_gt": _orders(lambda: pr.compare("o_totalprice", "gt", 250000.0)),
    "f_ge": _orders(lambda: pr.compare("o_custkey", "ge", 700)),
    "f_lt": _orders(lambda: pr.compare("o_totalprice", "lt", 50000.0)),
    "f_le": _orders(lambda: pr.compare("o_custkey", "le", 700)),
    "f_in": _orders(lambda: pr.one_of("o_orderpriority", "1-URGENT, 2-HIGH")),
    "f_and": _orders(lambda: pr.compare("o_orderstatus", "eq", "O") & pr.compare("o_totalprice", "gt", 100000.0)),
    "f_or": _orders(lambda: pr.compare("o_orderstatus", "eq", "P") | pr.compare("o_totalprice", "gt", 400000.0)),
    **{name.removeprefix("q_"): query for name, query in list(globals().items()) if name.startswith("q_")},
}

ORACLES = {
    "f_eq": _orders_sql("o_orderstatus = 'F'"),
    "f_ne": _orders_sql("o_orderstatus <> 'F'"),
    "f_gt": _orders_sql("o_totalprice > 250000"),
    "f_ge": _orders_sql("o_custkey >= 700"),
    "f_lt": _orders_sql("o_totalprice < 50000"),
    "f_le": _orders_sql("o_custkey <= 700"),
    "f_in": _orders_sql("o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    "f_and": _orders_sql("o_orderstatus = 'O' AND o_totalprice > 100000"),
    "f_or": _orders_sql("o_orderstatus = 'P' OR o_totalprice > 400000"),
    "f_bool": "SELECT doc_id, toxic FROM labels WHERE quality = 1",
    "f_any": "SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), 'red')",
    "f_nested_any": """SELECT p_partkey, p_name FROM part
      WHERE len([t for t in string_split(p_name, ' ') if length(t) >= 5 AND starts_with(t, 'g')]) > 0""",
    "f_json_path": "SELECT event_id, props FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) > 50",
    "f_variant_path": "SELECT event_id, props FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) > 50",
    "f_date_typed": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS at FROM orders
      WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'""",
    "f_date_text": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS at FROM orders
      WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'""",
    "f_prefix": "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'bl')",
    "f_text": """SELECT doc_id, lang, n_chars FROM documents
      WHERE list_contains(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), 'the') ORDER BY doc_id LIMIT 3""",
    "match_all": "SELECT doc_id, lang, source, n_chars FROM documents",
    "f_tenant": "SELECT doc_id, source, lang, n_chars FROM documents WHERE source = 'src3'",
    "partition_key": """SELECT lang, count(*) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents
      GROUP BY lang""",
    "facet_counts": "SELECT lang AS value, count(*) AS n_documents FROM documents GROUP BY 1",
    "facet_tags": """SELECT value, count(*) AS n_documents FROM
      (SELECT unnest(list_distinct(string_split(p_name, ' '))) AS value FROM part) GROUP BY 1""",
    "facets_all": """SELECT 'p_brand' AS field, p_brand AS value, count(*) AS n_documents FROM part GROUP BY 2
      UNION ALL SELECT 'p_size', p_size::VARCHAR, count(*) FROM part GROUP BY 2
      UNION ALL SELECT 'tags', value, count(*) FROM
      (SELECT unnest(list_distinct(string_split(p_name, ' '))) AS value FROM part) GROUP BY 2""",
    "sort_field": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey",
}
