"""Deliveries kept by sequence with state that expires: of all deliveries of a key the first by sequence is the one kept.

The state of a key is the order of the delivery given out, not its row, in RocksDB; it lives for ``ttl`` after it was
last written. A delivery is

* ``first`` where the key has no state,
* ``earlier`` where it comes before the one given out, which it replaces,
* ``again`` otherwise; those are counted and, where asked for, stored apart.

A key that comes back after its state is gone is ``first`` once more. The reader takes the least of what was given out for
a key, so the table is right whatever the order and the age of deliveries; the state only keeps repeats from being stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vecferry.streaming.changes import first_of_each

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {PROVIDER: ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
SALTS = 8
VERDICT = "_verdict"


@contextmanager
def keyed_state(spark: SparkSession):
    """Settings for streams started in the block; the session's own come back afterwards.

    State is in RocksDB, and there are no batches without data: with processing time Spark would plan them for ever, and
    a stream that reads what is there would not end.
    """
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _order(values: tuple) -> tuple:
    """Nulls come first, as they do in Spark."""
    return tuple((v is not None, v) for v in values)


class _FirstBySequence(StatefulProcessor):
    def __init__(self, order: list[str], state: T.StructType, out: T.StructType, ttl_ms: int, report: bool):
        self.order, self.state, self.out, self.ttl_ms, self.report = order, state, out, ttl_ms, report

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.given = handle.getValueState("given", self.state, self.ttl_ms)

    def _row(self, row: Row, verdict: str) -> Row:
        return Row(**{name: verdict if name == VERDICT else row[name] for name in self.out.names})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        given = self.given.get()
        known = given is not None
        given = tuple(given) if known else None
        best = None
        for row in rows:  # one row is held, however many a key has
            order = tuple(row[name] for name in self.order)
            if given is None or _order(order) < _order(given):
                if best is not None and self.report:
                    yield self._row(best, "again")
                best, given = row, order
            elif self.report:
                yield self._row(row, "again")
        if best is not None:
            self.given.update(given)
            yield self._row(best, "earlier" if known else "first")

    def close(self) -> None:
        pass


def _number(column: Column, kind: T.DataType) -> Column:
    """Times as microseconds, so that the state holds plain numbers."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    return F.unix_date(column) if isinstance(kind, T.DateType) else column


def first_by_sequence(
    stream: DataFrame, key: str, sequence: list[str], ttl: str = "7 days", salts: int = SALTS, report: bool = False
) -> DataFrame:
    """The deliveries of a stream that are given out, with ``_verdict``; with ``report`` also those that are not.

    Equal sequences are decided by the least digest of the row. A key is spread over ``salts`` states by that digest, so a
    key with a large share of the rows is not one task's work; it then has up to ``salts`` rows given out, of which the
    reader takes the first. A null key is a key. ``sequence`` holds numbers, texts, dates and times.
    """
    spark = stream.sparkSession
    ttl_ms = spark.sql(f"SELECT unix_millis(timestamp '1970-01-01 00:00:00 UTC' + interval {ttl})").first()[0]
    fields = {f.name: f.dataType for f in stream.schema.fields}
    others = [c for c in stream.columns if c != key]
    order = [f"_order{at}" for at in range(len(sequence))]
    ordered = stream.select(
        "*", *[_number(F.col(c), fields[c]).alias(name) for c, name in zip(sequence, order, strict=True)],
        F.xxhash64(*(others or [key])).alias("_digest"))
    salted = ordered.withColumn("_salt", F.pmod("_digest", F.lit(salts)).cast("int"))
    held = [*order, "_digest"]
    state = T.StructType([T.StructField(c, salted.schema[c].dataType) for c in held])
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in stream.schema.fields], T.StructField(VERDICT, T.StringType())])
    return salted.groupBy(key, "_salt").transformWithState(
        _FirstBySequence(held, state, out, ttl_ms, report), outputStructType=out, outputMode="Update", timeMode="ProcessingTime")


def keep_first(stream: DataFrame, path: str, checkpoint: str, key: str, sequence: list[str], ttl: str = "7 days", report: bool = False):
    """Stores what ``first_by_sequence`` gives out, a folder per micro-batch, which a batch that runs again overwrites.

    Returns the query, at its end; its progress has the number of states. ``first_rows`` reads the table.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    with keyed_state(stream.sparkSession):
        query = (
            first_by_sequence(stream, key, sequence, ttl, report=report).writeStream.foreachBatch(batch).outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    return query


def first_rows(spark: SparkSession, path: str, key: str, sequence: list[str]) -> DataFrame:
    """One row per key: the first by sequence of all deliveries so far."""
    given = spark.read.parquet(path).filter(F.col(VERDICT) != "again").drop("batch_id", VERDICT)
    return first_of_each(given, key, sequence)


def repeats(spark: SparkSession, path: str) -> DataFrame:
    """The deliveries that were not given out, where ``report`` was asked for."""
    return spark.read.parquet(path).filter(F.col(VERDICT) == "again").drop("batch_id", VERDICT)
