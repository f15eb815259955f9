"""Sensor readings of any number for trying a load out. Every value follows from the row number and the seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecferry.functions.vectors import normalize

VECTOR_DIM = 48
STATIONS = 40
FLAGS = ["drift", "clipped", "interpolated", "night"]


def sensor_readings(spark: SparkSession, count: int, seed: int = 42, dim: int = VECTOR_DIM) -> DataFrame:
    """Documents with a text key, numbers, a flag, a time, a list, a nested record and a unit vector."""

    def drawn(name: str, below: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(name), F.lit(seed)), F.lit(below))

    def component(position: Column) -> Column:
        return F.pmod(F.xxhash64("id", position, F.lit(seed)), F.lit(2_000_001)) / 1_000_000.0 - 1.0

    station = drawn("station", STATIONS)
    level = F.round(drawn("level", 8_000) / 100.0 - 30, 2)
    taken = F.timestamp_add("SECOND", drawn("second", 86_400 * 90).cast("int"), F.lit("2023-06-01").cast("timestamp_ntz"))
    flags = F.filter(F.array(*[F.when(drawn(flag, 4) == 0, F.lit(flag)) for flag in FLAGS]), lambda f: f.isNotNull())
    return spark.range(count).select(
        F.format_string("reading/%09d", "id").alias("reading"),
        F.format_string("st-%02d", station).alias("station"),
        level.alias("level"),
        drawn("samples", 600).cast("int").alias("samples"),
        (drawn("manual", 10) == 0).alias("manual"),
        F.date_format(taken, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("taken_at"),
        flags.alias("flags"),
        F.struct(F.format_string("probe %d", drawn("probe", 7)).alias("probe"), F.round(drawn("depth", 900) / 10.0, 1).alias("depth")).alias("device"),
        F.format_string("%s measured %.2f over %d samples", F.format_string("st-%02d", station), level, drawn("samples", 600)).alias("remark"),
        normalize(F.transform(F.sequence(F.lit(1), F.lit(dim)), component)).cast("array<float>").alias("signature"),
    )
