"""Target tables: create, append, split by outcome, partition, report. All plain Spark writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecferry.functions.coerce import FieldSpec
from vecferry.functions.edm import KEY_TYPES
from vecferry.operators.transform import REASON, target_schema


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at the path, whatever it holds and in whichever store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def target_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is taken; also by a first load that has written no complete file yet."""
    return folder_exists(spark, path)


def create_target(spark: SparkSession, path: str, specs: list[FieldSpec], drop_existing: bool = False) -> bool:
    """Creates an empty table with the compiled schema; an existing one stays unless dropped."""
    if target_exists(spark, path) and not drop_existing:
        return False
    empty = spark.createDataFrame([], target_schema(specs))
    empty.write.mode("overwrite" if drop_existing else "errorifexists").parquet(path)
    return True


def append(rows: DataFrame, path: str, name: str = "load") -> int:
    """Appends and returns the number of rows, counted while they are written."""
    seen = Observation(name)
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def write_outcomes(transformed: DataFrame, path: str) -> dict[str, int]:
    """Good and rejected rows in one pass over the source, each below its own ``outcome`` folder."""
    bad = F.col(REASON).isNotNull()
    seen = Observation("outcomes")
    (
        transformed.withColumn("outcome", F.when(bad, "rejected").otherwise("accepted"))
        .observe(seen, F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))
        .write.mode("overwrite").partitionBy("outcome").parquet(path)
    )
    return seen.get


def read_outcome(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """Only the folder of that outcome is read."""
    rows = spark.read.parquet(path).filter(F.col("outcome") == outcome).drop("outcome")
    return rows.drop(REASON) if outcome == "accepted" else rows


def hash_bucket(column: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def balanced(rows: DataFrame, layout: str) -> DataFrame:
    """Rows of one layout value together, as far as sizes allow.

    Spark merges small values into one task and splits a value that holds a large share of the rows.
    """
    return rows.hint("rebalance", layout)


def write_partitioned(rows: DataFrame, path: str, key: FieldSpec, buckets: int | None = None) -> str | None:
    """Lays a table out by its partition key and returns the layout column.

    Only INT64 and VARCHAR keys qualify; others are ignored and the table is written unpartitioned.
    A key with many values goes to hash ``buckets``.
    """
    if key.target_type not in KEY_TYPES:
        rows.write.mode("overwrite").parquet(path)
        return None
    layout = key.target if buckets is None else f"{key.target}_bucket"
    laid_out = rows if buckets is None else rows.withColumn(layout, hash_bucket(F.col(key.target), buckets))
    balanced(laid_out, layout).write.mode("overwrite").partitionBy(layout).parquet(path)
    return layout


def write_reports(path: str, **reports: DataFrame) -> None:
    """One folder of JSON lines per report table (fields, indexes, warnings, summary ...).

    A line per row rather than one nested document per index: an index may have any number of fields.
    """
    for name, report in reports.items():
        report.write.mode("overwrite").json(f"{path}/{name}")


def index_reports(fields: DataFrame, indexes: DataFrame, part_size: int = 1_000) -> DataFrame:
    """A report per index: ``index_name, part, n_parts`` with ``fields`` and ``indexes`` as arrays of structs.

    An index with more than ``part_size`` fields, or indexes, is reported in numbered parts, so a row is bounded.
    """
    def parts(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
        others = [c for c in rows.columns if c != "index_name"]
        at = F.row_number().over(Window.partitionBy("index_name").orderBy(*order))
        numbered = rows.withColumn("part", F.floor((at - 1) / part_size).cast("int")).withColumn("_at", at)
        entries = F.array_sort(F.collect_list(F.struct("_at", F.struct(*others).alias("row"))))
        return numbered.groupBy("index_name", "part").agg(F.transform(entries, lambda e: e["row"]).alias(name))

    met = parts(fields, "fields", ["ordinal", "field_name"]).join(parts(indexes, "indexes", ["field_name"]), ["index_name", "part"], "full_outer")
    filled = met.select("index_name", "part", *[F.coalesce(c, F.array().cast(met.schema[c].dataType)).alias(c) for c in ("fields", "indexes")])
    return filled.select("index_name", "part", (F.max("part").over(Window.partitionBy("index_name")) + 1).alias("n_parts"), "fields", "indexes")


def write_index_reports(path: str, fields: DataFrame, indexes: DataFrame, part_size: int = 1_000) -> None:
    """One JSON line per index, or per part of one."""
    index_reports(fields, indexes, part_size).write.mode("overwrite").json(path)
