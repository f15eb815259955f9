"""Two tables compared by digests first, and row by row only where those differ.

Keys fall in leaves by the leading bits of their hash. The digest of a leaf is the number of its rows and sums of two
64-bit hashes of each, so it does not depend on order, and partial sums combine where rows are read: a side is
digested in one pass without shuffling a row. A node above sums its leaves. Two sides are compared from the root down;
below a node that agrees nothing is looked at. Digests can be stored beside a table and compared without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.operators.reconcile import reconcile
from vecferry.session import written

BITS = 12
STEP = 4  # bits from a node to its children
KEYLESS = -1  # leaf of rows without a key: no two of them are the same row
SUMS = ["n", "a_high", "a_low", "b_high", "b_low"]


def leaf_of(key: str, bits: int = BITS) -> Column:
    return F.when(F.col(key).isNull(), F.lit(KEYLESS).cast("long")).otherwise(F.shiftrightunsigned(F.xxhash64(key), 64 - bits))


def _hashed(rows: DataFrame, column: str) -> Column:
    """The column, or the text of a nested one: hashes of lists and structs pass over nulls inside."""
    nested = isinstance(rows.schema[column].dataType, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(F.struct(column), {"ignoreNullFields": "false"}) if nested else F.col(column)


def leaf_digests(rows: DataFrame, key: str, columns: list[str], bits: int = BITS) -> DataFrame:
    """``leaf, n`` and the four sums; one row per leaf that has rows. Which values are null is part of the digest."""
    values = [key, *[_hashed(rows, c) for c in columns], *[F.isnull(c) for c in columns]]
    hashes = {side: F.xxhash64(F.lit(side), *values) for side in ("a", "b")}
    parts = {}
    for side, value in hashes.items():
        parts[f"{side}_high"], parts[f"{side}_low"] = F.shiftrightunsigned(value, 32), value.bitwiseAND(0xFFFFFFFF)
    return rows.select(leaf_of(key, bits).alias("leaf"), F.lit(1).cast("long").alias("n"), *[c.alias(n) for n, c in parts.items()]).groupBy("leaf").agg(
        *[F.sum(c).alias(c) for c in SUMS])


def differing_leaves(left: DataFrame, right: DataFrame, bits: int = BITS, step: int = STEP) -> DataFrame:
    """``leaf`` of those in which the two sides differ, found from the root down."""
    suspects = None
    for shift in range(-(-bits // step) * step, -1, -step):
        sides = []
        for digests in (left, right):
            level = digests.filter(F.col("leaf") >= 0).withColumn("leaf", F.shiftright("leaf", shift))
            if suspects is not None:
                level = level.withColumn("_up", F.shiftright("leaf", step)).join(suspects.withColumnRenamed("leaf", "_up"), "_up", "left_semi")
            sides.append(level.groupBy("leaf").agg(*[F.sum(c).alias(c) for c in SUMS]))
        other = sides[1].select("leaf", *[F.col(c).alias(f"_{c}") for c in SUMS])
        same = F.lit(True)
        for c in SUMS:
            same = same & F.equal_null(F.col(c), F.col(f"_{c}"))
        suspects = sides[0].join(other, "leaf", "full_outer").filter(~same).select("leaf")
    return suspects


def reconcile_by_digest(
    source: DataFrame, target: DataFrame, key: str, columns: list[str], bits: int = BITS, digest: bool = False,
    source_digests: DataFrame | None = None, target_digests: DataFrame | None = None,
) -> DataFrame:
    """The same rows as ``reconcile``. Only leaves that differ are shuffled and joined; of the others the keys are counted.

    Digests that are stored already, from ``leaf_digests`` with the same columns and bits, spare a pass over their side.
    """
    left = written(leaf_digests(source, key, columns, bits), "digests") if source_digests is None else source_digests
    right = written(leaf_digests(target, key, columns, bits), "digests") if target_digests is None else target_digests
    keyless = source.sparkSession.range(1).select(F.lit(KEYLESS).cast("long").alias("_leaf"))
    leaves = written(differing_leaves(left, right, bits).select(F.col("leaf").alias("_leaf")).unionByName(keyless), "leaves")

    def within(rows: DataFrame, how: str) -> DataFrame:
        return rows.select(key, *columns, leaf_of(key, bits).alias("_leaf")).join(leaves, "_leaf", how).drop("_leaf")

    looked = reconcile(within(source, "left_semi"), within(target, "left_semi"), key, columns, digest)
    alike = within(source.select("*"), "left_anti").agg(F.count_distinct(key).alias("n"))
    return looked.withColumn("n_match", F.col("n_match") + alike.select("n").scalar())
