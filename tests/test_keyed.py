import random
import time

import pytest
from pyspark.sql import functions as F

from vecferry.streaming import keyed, load

SCHEMA = "k long, s long, v string"


def deliver(spark, source, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)


def ingest(spark, tmp_path, **options):
    stream = load.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema)
    return keyed.keep_first(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "k", ["s"], **options)


def kept(spark, tmp_path):
    return sorted(map(tuple, keyed.first_rows(spark, str(tmp_path / "out"), "k", ["s"]).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_first_by_sequence_whatever_the_arrival(spark, tmp_path, seed):
    rows = [(k, s, f"{k}-{s}") for k in range(30) for s in range(5)] + [(0, s, "hot") for s in range(5, 200)]
    random.Random(seed).shuffle(rows)
    for at in range(0, len(rows), 120):
        deliver(spark, str(tmp_path / "in"), rows[at : at + 120])
    ingest(spark, tmp_path, report=True)
    assert kept(spark, tmp_path) == sorted([(k, 0, f"{k}-0") for k in range(30)], key=str)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == len(rows)  # every delivery has a verdict
    again = keyed.repeats(spark, str(tmp_path / "out"))
    assert again.count() == stored.filter(F.col("_verdict") == "again").count() > 0


def test_earlier_replaces_and_nulls_come_first(spark, tmp_path):
    source = str(tmp_path / "in")
    for rows in ([(1, 5, "a"), (None, 1, "n"), (2, 7, "x"), (2, 7, "x")], [(1, 2, "b"), (None, 0, None)], [(1, None, "c"), (2, 9, "y")]):
        deliver(spark, source, rows)
        ingest(spark, tmp_path)
    assert kept(spark, tmp_path) == sorted([(1, None, "c"), (2, 7, "x"), (None, 0, None)], key=str)
    assert spark.conf.get(keyed.PROVIDER, "") != keyed.ROCKSDB


def test_state_expires_and_the_table_stays_right(spark, tmp_path):
    source = str(tmp_path / "in")
    states = []
    for start in (0, 100, 200):
        deliver(spark, source, [(k, 3, "x") for k in range(start, start + 100)] + [(0, 2 + start, "late")])
        query = ingest(spark, tmp_path, ttl="2 seconds")
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(3)
    found = kept(spark, tmp_path)
    assert len(found) == 300 and (0, 2, "late") in found
    assert max(states) < 300  # the states of the batches before are gone
