"""Target tables of the catalog, by name: bucketed and sorted by key.

Two tables with equally many buckets meet on their key without a shuffle of either: loading what is missing, and
reconciling source and target, read bucket against bucket. Every write sends a bucket's rows to one task, so an append
adds one file per bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vecferry.functions.coerce import FieldSpec
from vecferry.operators.transform import target_schema

BUCKETS = 64


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _key(specs: list[FieldSpec]) -> str:
    keys = [s.target for s in specs if s.is_key]
    if len(keys) != 1:
        raise ValueError(f"a table needs one key, not {len(keys)}")
    return keys[0]


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """How many buckets a table has, and by which columns."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in described:
        raise ValueError(f"{name} has no buckets")
    return int(described["Num Buckets"]), [c.strip(" `") for c in described["Bucket Columns"].strip("[]").split(",")]


def _write(rows: DataFrame, name: str, key: str, buckets: int, mode: str, path: str | None) -> None:
    writer = rows.repartition(buckets, key).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def create_table(
    spark: SparkSession, name: str, specs: list[FieldSpec], buckets: int = BUCKETS, drop_existing: bool = False, path: str | None = None
) -> bool:
    """Creates an empty table with the compiled schema, bucketed by its key; an existing one stays unless dropped.

    With ``path`` the table is external and lies there, else in the warehouse.
    """
    if table_exists(spark, name):
        if not drop_existing:
            return False
        spark.sql(f"DROP TABLE {name}")
    _write(spark.createDataFrame([], target_schema(specs)), name, _key(specs), buckets, "overwrite" if path else "errorifexists", path)
    return True


def save_table(rows: DataFrame, name: str, key: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """Any rows as a new table, bucketed by a column of theirs."""
    _write(rows, name, key, buckets, "errorifexists", path)


def append_table(rows: DataFrame, name: str) -> int:
    """Appends to an existing table in its own buckets; returns how many rows, counted while they are written."""
    spark = rows.sparkSession
    buckets, (key, *_) = bucketing(spark, name)
    seen = Observation("append")
    ordered = rows.select(*spark.table(name).columns).observe(seen, F.count(F.lit(1)).alias("n"))
    _write(ordered, name, key, buckets, "append", None)
    return seen.get["n"]


def load_missing(rows: DataFrame, name: str) -> int:
    """Appends the rows whose key the table does not have: resuming a load by key, whatever it did before."""
    spark = rows.sparkSession
    _, (key, *_) = bucketing(spark, name)
    return append_table(rows.join(spark.table(name).select(key), key, "left_anti"), name)
