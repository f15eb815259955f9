"""Checks of a loaded table against its source. Each check is one row: name, passed, expected, actual, message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNT_TOLERANCE_PCT = 1.0
FILL_RATE_PCT = 50.0


def _check(name: str, passed: Column, expected: Column, actual: Column, message: Column | None = None) -> list[Column]:
    expected, actual = expected.cast("string"), actual.cast("string")
    said = F.concat(F.lit("expected "), expected, F.lit(", found "), F.coalesce(actual, F.lit("nothing"))) if message is None else message
    return [
        F.lit(name).alias("name"), passed.alias("passed"), expected.alias("expected"), actual.alias("actual"), said.alias("message"),
    ]


def count_difference_pct(expected: Column, actual: Column) -> Column:
    return F.abs(expected - actual) / expected * 100


def check_count(source: DataFrame, target: DataFrame, tolerance_pct: float = COUNT_TOLERANCE_PCT) -> DataFrame:
    """Row counts agree within the tolerance; an empty source passes. The message has the difference in percent."""
    counted = source.agg(F.count("*").alias("expected")).withColumn(
        "actual", target.agg(F.count("*").alias("n")).scalar()
    )
    expected, actual = F.col("expected"), F.col("actual")
    apart = count_difference_pct(F.nullif(expected, F.lit(0)), actual)
    passed = F.when(expected == 0, F.lit(True)).otherwise(apart <= tolerance_pct)
    message = F.when(expected == 0, F.lit("the source is empty")).otherwise(F.concat(
        expected.cast("string"), F.lit(" rows in the source, "), actual.cast("string"), F.lit(" in the target, "),
        F.format_string("%.2f", apart), F.lit(" % apart")))
    return counted.select(*_check("document_count", passed, expected, actual, message))


def check_field_count(conversions: DataFrame, actual_per_index: DataFrame) -> DataFrame:
    """Every index has at least as many target columns as it has kept fields."""
    expected = conversions.groupBy("index_name").agg(F.count_if(~F.col("skipped")).alias("expected"))
    return expected.join(actual_per_index, "index_name", "left").select(
        "index_name", "expected", F.coalesce("actual", F.lit(0)).cast("long").alias("actual"),
        (F.coalesce("actual", F.lit(0)) >= F.col("expected")).alias("passed"),
    )


def check_columns(expected_fields: int, target: DataFrame) -> DataFrame:
    """Field count of one target table, as a check row next to the others."""
    n_columns = len(target.columns)
    one = target.sparkSession.range(1)
    return one.select(*_check("field_count", F.lit(n_columns >= expected_fields), F.lit(expected_fields), F.lit(n_columns)))


def fill_rates(target: DataFrame, columns: list[str]) -> DataFrame:
    """Share of filled values per column, in one pass over all rows."""
    counted = target.agg(F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in columns])
    return counted.select("_rows", F.explode(pairs).alias("p")).select(
        "p.field", "p.filled", F.col("_rows").alias("checked"),
        F.round(F.try_divide(F.col("p.filled") * 100, F.col("_rows")), 6).alias("fill_pct"),
    )


def check_fill_rate(target: DataFrame, columns: list[str], threshold_pct: float = FILL_RATE_PCT) -> DataFrame:
    """More than the threshold of all scalar values are filled; an empty table passes."""
    totals = fill_rates(target, columns).agg(F.sum("filled").alias("filled"), F.sum("checked").alias("checked"))
    rate = F.try_divide(F.col("filled") * 100, F.col("checked"))
    passed = F.coalesce(rate > threshold_pct, F.lit(True))
    return totals.select(*_check(
        "fill_rate", passed, F.lit(f">{threshold_pct:g}%"), F.concat(F.round(rate, 1).cast("string"), F.lit("%"))
    ))


def stored_size(target_type: str, dim: int) -> int:
    """What a vector of that type is long: elements of a float vector, bytes of a packed one."""
    return {"FLOAT16_VECTOR": 2 * dim, "BINARY_VECTOR": -(-dim // 8)}.get(target_type, dim)


def check_dimension(target: DataFrame, vector: str, dim: int, target_type: str = "FLOAT_VECTOR") -> DataFrame:
    """All present vectors have the declared dimension; packed vectors are measured in bytes."""
    packed = isinstance(target.schema[vector].dataType, T.BinaryType)
    size = F.octet_length(vector) if packed else F.size(vector)
    wanted = stored_size(target_type, dim) if packed else dim
    found = target.filter(F.col(vector).isNotNull()).agg(
        F.min(size).alias("lowest"), F.max(size).alias("highest"), F.count_if(size != wanted).alias("wrong")
    )
    actual = F.when(F.col("lowest") == F.col("highest"), F.col("lowest").cast("string")).otherwise(
        F.concat(F.col("lowest").cast("string"), F.lit(".."), F.col("highest").cast("string"))
    )
    return found.select(*_check(f"vector_dim_{vector}", F.col("wrong") == 0, F.lit(wanted), actual))


def check_reconciled(differences: DataFrame) -> DataFrame:
    """No missing, extra, repeated or differing values in the counts of ``reconcile``; none at all passes."""
    kinds = ("n_missing", "n_extra", "n_duplicate", "n_different")
    bad = differences.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in kinds])
    total = sum((F.col(c) for c in kinds[1:]), F.col(kinds[0]))
    message = F.concat_ws(", ", *[F.concat(F.col(c).cast("string"), F.lit(f" {c.removeprefix('n_')}")) for c in kinds])
    return bad.select(*_check("values", total == 0, F.lit(0), total, message))


def check_vectors(agreement: DataFrame, vector: str) -> DataFrame:
    """Every vector of the source is in the target, once and unchanged, by the counts of ``vector_agreement``."""
    kinds = ("n_apart", "n_missing", "n_extra", "n_duplicate", "n_null", "n_other_length")
    total = sum((F.col(c) for c in kinds[1:]), F.col(kinds[0]))
    message = F.concat_ws(", ", *[F.concat(F.col(c).cast("string"), F.lit(f" {c.removeprefix('n_')}")) for c in kinds])
    return agreement.select(*_check(f"vector_values_{vector}", total == 0, F.lit(0), total, message))


def roll_up(checks: DataFrame) -> DataFrame:
    """All checks in one line."""
    totals = checks.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
        F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_failed"),
    )
    return totals.withColumn("summary", F.concat(
        F.lit("["), F.when(F.col("all_passed"), "PASS").otherwise("FAIL"), F.lit("] "), F.col("n_passed").cast("string"),
        F.lit("/"), (F.col("n_passed") + F.col("n_failed")).cast("string"), F.lit(" checks passed"),
    ))
