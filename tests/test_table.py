import random

import pytest
from pyspark.sql import functions as F

from vecferry.streaming import load, table

CHANGES = "k int, seq int, op string, v string"
DELETED = "op = 'del'"


class Feed:
    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options, self.all = spark, folder, options, []
        self.path = f"{folder}/table"

    def add(self, rows):
        self.spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(f"{self.folder}/feed")
        self.all += rows
        self.run()

    def run(self):
        self.spark.createDataFrame([], CHANGES).write.mode("append").parquet(f"{self.folder}/feed")
        stream = load.read_stream(self.spark, f"{self.folder}/feed", self.spark.createDataFrame([], CHANGES).schema)
        table.apply_to_table(stream, self.path, f"{self.folder}/cp", ["k"], ["seq"], **self.options)

    def state(self):
        return {r.k: (r.seq, r.v) for r in table.table_state(self.spark, self.path, ["k"], ["seq"], F.expr(DELETED)).collect()}

    def expected(self):
        last = {}
        for k, seq, op, v in self.all:
            last[k] = max(last.get(k, (seq, op, v)), (seq, op, v), key=lambda x: x[0])
        return {k: (seq, v) for k, (seq, op, v) in last.items() if op != "del"}

    def bytes_of(self, prefix):
        import pathlib

        return sum(p.stat().st_size for p in pathlib.Path(self.path, "rows").glob(f"{prefix}*/**/*.parquet"))


def some(rnd, n, seq, keys=3000):
    return [(rnd.randrange(keys), seq + rnd.randrange(-200, 200) * 1000 + i, "del" if rnd.random() < 0.2 else "put", f"v{rnd.random()}") for i, _ in enumerate(range(n))]


def test_state_before_and_after_compaction_and_splits(spark, tmp_path):
    feed, rnd = Feed(spark, str(tmp_path), compact=False), random.Random(1)
    for n in range(5):
        feed.add(some(rnd, 800, (n + 1) * 1000))
    assert feed.state() == feed.expected()
    assert {r.level for r in table.state(spark, feed.path).runs} == {0}
    assert table.compact_table(spark, feed.path, ["k"], ["seq"], fan_in=3)
    merged = table.state(spark, feed.path)
    assert {r.level for r in merged.runs} == {1} and len(merged.runs) == len(merged.buckets) == 8
    assert feed.state() == feed.expected()
    assert table.compact_table(spark, feed.path, ["k"], ["seq"], bucket_bytes=3000)
    split = table.state(spark, feed.path)
    assert len(split.buckets) > 8 and feed.state() == feed.expected()
    while table.compact_table(spark, feed.path, ["k"], ["seq"], bucket_bytes=3000):
        pass
    assert all(r.bytes <= 3000 for r in table.state(spark, feed.path).runs)
    before = feed.bytes_of("")
    assert table.vacuum(spark, feed.path) > 5 and feed.bytes_of("") < before
    feed.add([(k, 10**7, "put", "new") for k in range(0, 3000, 50)] + [(7, -1, "put", "too late")])
    assert feed.state() == feed.expected()


def test_a_batch_writes_its_own_size_not_that_of_the_table(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), fan_in=100)
    feed.add([(k, 1, "put", f"{k * 7919 % 104729:030d}") for k in range(50_000)])
    large = feed.bytes_of("batch-")
    feed.add([(k, 2, "put", "x") for k in range(0, 50_000, 5000)])  # ten keys, in most of the buckets
    assert feed.bytes_of("batch-") - large < large / 20
    assert feed.bytes_of("compacted-") == 0 and len(feed.state()) == 50_000


def test_rows_are_rewritten_once_per_level(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), fan_in=2)
    for n in range(8):
        feed.add([(k, 1, "put", f"{k:050d}") for k in range(n * 500, (n + 1) * 500)])
    levels = [r.level for r in table.state(spark, feed.path).runs]
    assert max(levels) == 3 and len(levels) == 8
    assert feed.bytes_of("compacted-") <= 3.5 * feed.bytes_of("batch-") and len(feed.state()) == 4000


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    feed.add([(1, 1, "put", "a"), (2, 1, "put", "b")])
    version = table.state(spark, feed.path).version
    stream = load.read_stream(spark, f"{tmp_path}/feed", spark.createDataFrame([], CHANGES).schema)
    table.apply_to_table(stream, feed.path, f"{tmp_path}/lost-checkpoint", ["k"], ["seq"])  # its batch 0 is in the log
    now = table.state(spark, feed.path)
    assert (now.version, feed.state()) == (version, {1: (1, "a"), 2: (1, "b")})


def test_an_empty_feed_gives_an_empty_table(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    feed.run()
    assert feed.state() == {}
    feed.add([(1, 1, "put", "a")])
    assert feed.state() == {1: (1, "a")}


def test_log_is_read_from_its_last_checkpoint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(table, "CHECKPOINT", 2)
    feed = Feed(spark, str(tmp_path), fan_in=2)
    for n in range(5):
        feed.add([(n, n, "put", "a"), (0, n, "put", f"b{n}")])
    names = table._Files(spark, feed.path).names("log")
    assert any(n.endswith(".all.json") for n in names) and feed.state() == feed.expected()
    table.vacuum(spark, feed.path)
    assert len(table._Files(spark, feed.path).names("log")) < len(names) and feed.state() == feed.expected()
    with pytest.raises(RuntimeError, match="another stream"):
        table._Files(spark, feed.path).write(f"log/{[n for n in names if n.endswith('.all.json')][-1]}", {})


def test_many_buckets_are_looked_up_by_a_join(spark, monkeypatch):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    buckets = [f"4-{p}" for p in range(15)] + ["5-30", "6-62", "6-63"]
    by_expression = {r.k: r._bucket for r in table.with_bucket(rows, ["k"], buckets).collect()}
    monkeypatch.setattr(table, "JOINED_BUCKETS", 3)
    assert {r.k: r._bucket for r in table.with_bucket(rows, ["k"], buckets).collect()} == by_expression
    assert set(by_expression.values()) == set(buckets)
