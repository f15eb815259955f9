"""Source against target, key by key and value by value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.functions.vectors import cosine, l2_distance


def _comparable(df: DataFrame, column: str, digest: bool) -> Column:
    """Wide values travel through the shuffle as a 32-byte digest instead of the value itself."""
    kind = df.schema[column].dataType
    if not digest or not isinstance(kind, (T.StringType, T.ArrayType, T.BinaryType, T.StructType)):
        return F.col(column)
    value = F.col(column) if isinstance(kind, (T.StringType, T.BinaryType)) else F.to_json(F.struct(column))
    return F.when(F.col(column).isNotNull(), F.unhex(F.sha2(value, 256)))


def _by_key(rows: DataFrame, key: str, columns: list[str], digest: bool, side: str) -> DataFrame:
    """One row per key with the number of rows that have it; of several rows the least one stands for the key."""
    values = F.struct(*[_comparable(rows, c, digest).alias(f"{side}_{c}") for c in columns])
    return rows.select(F.col(key), values.alias("_v")).groupBy(key).agg(
        F.min("_v").alias("_v"), F.count("*").alias(f"{side}_rows")).select(key, "_v.*", f"{side}_rows")


def paired(source: DataFrame, target: DataFrame, key: str, columns: list[str], digest: bool = False) -> DataFrame:
    """Full outer join on the key, one row per key; ``in_source`` and ``in_target`` tell where it was found.

    Each side is reduced to one row per key first, so a key that was stored many times is no hot key of the join.
    ``s_rows`` and ``t_rows`` say how many rows it had.
    """
    left, right = _by_key(source, key, columns, digest, "s"), _by_key(target, key, columns, digest, "t")
    return (
        left.join(right, key, "full_outer")
        .withColumn("in_source", F.col("s_rows").isNotNull())
        .withColumn("in_target", F.col("t_rows").isNotNull())
    )


def reconcile(source: DataFrame, target: DataFrame, key: str, columns: list[str], digest: bool = False) -> DataFrame:
    """Per column: keys that match, differ, miss in the target, exist only there, or have more rows there."""
    rows = paired(source, target, key, columns, digest)
    both = F.col("in_source") & F.col("in_target")
    counters = [
        F.count_if(F.col("in_source") & ~F.col("in_target")).alias("_missing"),
        F.count_if(F.col("in_target") & ~F.col("in_source")).alias("_extra"),
        F.count_if(F.col("t_rows") > F.coalesce("s_rows", F.lit(1))).alias("_duplicate"),
        F.count_if(both).alias("_both"),
        *[F.count_if(both & F.equal_null(F.col(f"s_{c}"), F.col(f"t_{c}"))).alias(f"_match_{c}") for c in columns],
    ]
    per_column = F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"_match_{c}").alias("n_match")) for c in columns
    ])
    return rows.agg(*counters).select("*", F.explode(per_column).alias("p")).select(
        "p.field", "p.n_match", (F.col("_both") - F.col("p.n_match")).alias("n_different"),
        F.col("_missing").alias("n_missing"), F.col("_extra").alias("n_extra"), F.col("_duplicate").alias("n_duplicate"),
    )


def missing_in_target(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows still to load: resuming by key instead of by offset."""
    return source.join(target.select(key), key, "left_anti")


def already_loaded(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    return source.join(target.select(key), key, "left_semi")


def vector_agreement(source: DataFrame, target: DataFrame, key: str, vector: str, tolerance: float = 1e-6) -> DataFrame:
    """Loaded vectors against their sources, over all keys of both sides.

    A pair is apart when its similarity is undefined or its distance exceeds the tolerance, so a scaled vector is told
    from its source too. Missing, extra, one-sided null and differently long vectors are counted by themselves.
    """
    rows = paired(source, target, key, [vector])
    s, t = F.col(f"s_{vector}"), F.col(f"t_{vector}")
    both = F.col("in_source") & F.col("in_target")
    present = both & s.isNotNull() & t.isNotNull()
    comparable = present & (F.size(s) == F.size(t))
    judged = rows.select(
        "in_source", "in_target", "s_rows", "t_rows", both.alias("both"),
        (both & (s.isNull() != t.isNull())).alias("one_null"), (present & (F.size(s) != F.size(t))).alias("other_length"),
        comparable.alias("compared"), F.when(comparable, cosine(s, t)).alias("sim"),
        F.when(comparable, l2_distance(s, t)).alias("distance"))
    agree = F.coalesce(F.col("sim").isNotNull() & (F.col("distance") <= tolerance), F.lit(False))
    return judged.agg(
        F.count_if("compared").alias("n_compared"), F.count_if(F.col("compared") & ~agree).alias("n_apart"),
        F.count_if(F.col("in_source") & ~F.col("in_target")).alias("n_missing"),
        F.count_if(F.col("in_target") & ~F.col("in_source")).alias("n_extra"),
        F.count_if(F.col("t_rows") > F.coalesce("s_rows", F.lit(1))).alias("n_duplicate"),
        F.count_if("one_null").alias("n_null"), F.count_if("other_length").alias("n_other_length"),
        F.round(F.min("sim"), 6).alias("lowest"),
    )
