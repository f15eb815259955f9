"""Facet counts: groupings that combine on the map side, so a common value costs no more than a rare one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def facet_counts(documents: DataFrame, column: str) -> DataFrame:
    return documents.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_documents"))


def array_facet_counts(documents: DataFrame, array: str) -> DataFrame:
    """Documents per distinct array element."""
    return facet_counts(documents.select(F.explode(F.array_distinct(array)).alias("value")), "value")


def facetable_fields(fields: DataFrame, index_name: str, max_fields: int = 1_000) -> list[str]:
    """The fields that a definition marks as facetable, in declared order; more than ``max_fields`` fail loudly."""
    found = fields.filter((F.col("index_name") == index_name) & F.col("facetable")).select("ordinal", "field_name").limit(max_fields + 1).collect()
    if len(found) > max_fields:
        raise ValueError(f"index {index_name} has more than {max_fields} facetable fields")
    return [r.field_name for r in sorted(found, key=lambda r: r.ordinal)]


def _named_elements(column: str) -> Column:
    return F.transform(column, lambda x: F.struct(F.lit(column).alias("field"), x.cast("string").alias("value")))


def all_facets(documents: DataFrame, columns: list[str]) -> DataFrame:
    """``field, value, n_documents`` of every column, with one scan and one aggregation over grouping sets.

    Values are given as text, a missing one as null. Elements of an array count once per document; arrays are taken apart
    first, in the same pass.
    """
    arrays = [c for c in columns if isinstance(documents.schema[c].dataType, T.ArrayType)]
    plain = [c for c in columns if c not in arrays]
    parts = documents.select(*plain, *[F.array_distinct(c).alias(c) for c in arrays])
    if arrays:
        # A row per document for the plain columns, and one per element of each array.
        kind = "array<struct<field: string, value: string>>"
        elements = [_named_elements(c) for c in arrays]
        own = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value")))
        all_rows = F.concat(own, *[F.coalesce(e, F.array().cast(kind)) for e in elements])
        parts = parts.select(*plain, F.explode(all_rows).alias("_e")).select(*plain, "_e.field", "_e.value")
        parts = parts.withColumnsRenamed({"field": "_field", "value": "_value"})
    sets = [[c] for c in plain] + ([["_field", "_value"]] if arrays else [])
    every = [*plain, *(["_field", "_value"] if arrays else [])]
    own_rows = F.count_if(F.col("_field").isNull()) if arrays else F.count("*")
    found = parts.groupingSets(sets, *every).agg(
        own_rows.alias("_own"), F.count("*").alias("_all"), *[F.grouping(c).alias(f"_out_{i}") for i, c in enumerate(every)])
    results = [F.when(F.col(f"_out_{i}") == 0, F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"), F.col("_own").alias("n_documents")))
               for i, c in enumerate(plain)]
    if arrays:
        results.append(F.when(F.col("_field").isNotNull(), F.struct(F.col("_field").alias("field"), F.col("_value").alias("value"), F.col("_all").alias("n_documents"))))
    return found.select(F.coalesce(*results).alias("r")).filter("r is not null").select("r.*")
