"""A table kept current by a change feed, merged when it is read.

Keys belong to buckets by the leading bits of their hash. Every batch appends one delta, the last change per key of the
batch, split by bucket; nothing that is stored already is read or written for it. Runs of a bucket are compacted by level:
``fan_in`` runs of a level become one of the next, so a row is rewritten once per level. A bucket that has outgrown
``bucket_bytes`` is split in two by one more bit of the hash when it is compacted, so buckets stay small enough for a task
however large the table becomes. Reading merges the runs of each bucket; a bucket of one run is read as it is.

A log says which runs are live. A commit is one small file of what was added and dropped, named by its version and put in
place by a rename; every ``CHECKPOINT`` versions the whole state is written, and readers begin there. A batch that comes
again after a crash finds itself in the log and does nothing; folders that no commit names are never read, and ``vacuum``
deletes them. One stream writes a table at a time. Deletes are kept as changes, so late ones find their order.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecferry.sources.target import balanced, folder_exists
from vecferry.streaming.changes import latest_changes, run_batches

BUCKET = "_bucket"
FIRST_BITS = 3
FAN_IN = 8
BUCKET_BYTES = 512 * 1024 * 1024
CHECKPOINT = 32
JOINED_BUCKETS = 256  # more buckets than these are looked up by a join


@dataclass(frozen=True)
class Run:
    """Some rows of one bucket, sorted out of a batch or a compaction."""

    bucket: str
    folder: str
    level: int
    bytes: int

    def path(self, table: str) -> str:
        return f"{table}/rows/{self.folder}/{BUCKET}={self.bucket}"


@dataclass
class State:
    """The table as of one version."""

    version: int = -1
    last_batch: int = -1
    buckets: list[str] = field(default_factory=lambda: [f"{FIRST_BITS}-{p}" for p in range(1 << FIRST_BITS)])
    runs: list[Run] = field(default_factory=list)

    def apply(self, commit: dict) -> None:
        self.version, self.last_batch = commit["version"], max(self.last_batch, commit["batch"])
        dropped = {tuple(d) for d in commit["drop"]}
        self.runs = [r for r in self.runs if (r.bucket, r.folder) not in dropped] + [Run(*a) for a in commit["add"]]
        if commit["split"]:
            gone = set(commit["split"])
            self.buckets = [b for b in self.buckets if b not in gone] + [half for b in commit["split"] for half in _halves(b)]


def _halves(bucket: str) -> list[str]:
    bits, prefix = map(int, bucket.split("-"))
    return [f"{bits + 1}-{2 * prefix + i}" for i in range(2)]


def _prefix(keys: list[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def with_bucket(rows: DataFrame, keys: list[str], buckets: list[str]) -> DataFrame:
    """The rows with their bucket: an expression while there are few, else a join with all prefixes of the longest length."""
    known = sorted((int(b.split("-")[0]), int(b.split("-")[1]), b) for b in buckets)
    depths = sorted({bits for bits, *_ in known})
    if len(depths) == 1:
        return rows.withColumn(BUCKET, F.concat(F.lit(f"{depths[0]}-"), _prefix(keys, depths[0]).cast("string")))
    if len(known) <= JOINED_BUCKETS:
        choice = F.coalesce(*[
            F.when(_prefix(keys, bits).isin([p for b, p, _ in known if b == bits]), F.concat(F.lit(f"{bits}-"), _prefix(keys, bits).cast("string")))
            for bits in depths])
        return rows.withColumn(BUCKET, choice)
    deepest = depths[-1]
    slots = [((p << (deepest - bits)) + i, b) for bits, p, b in known for i in range(1 << (deepest - bits))]
    directory = rows.sparkSession.createDataFrame(slots, f"_slot long, {BUCKET} string")
    return rows.withColumn("_slot", _prefix(keys, deepest)).join(directory, "_slot").drop("_slot")


class _Files:
    """Small files of the log, in whichever store the table is."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.path = spark._jvm, path
        self.system = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self._at(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(self._at(folder)))

    def read(self, name: str) -> dict:
        stream = self.system.open(self._at(name))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, body: dict) -> None:
        """In place at once, or not at all; a name that is taken is an error."""
        hidden, final = self._at(f"log/.{uuid.uuid4().hex}"), self._at(name)
        stream = self.system.create(hidden, True)
        try:
            stream.write(bytearray(json.dumps(body).encode()))
        finally:
            stream.close()
        if self.system.exists(final) or not self.system.rename(hidden, final):
            raise RuntimeError(f"{name} exists: another stream writes this table")

    def delete(self, name: str) -> None:
        self.system.delete(self._at(name), True)

    def sizes(self, folder: str) -> dict[str, int]:
        """Bytes by bucket folder below a folder of rows."""
        found: dict[str, int] = {}
        if self.system.exists(self._at(folder)):
            files = self.system.listFiles(self._at(folder), True)
            while files.hasNext():
                status = files.next()
                parent = status.getPath().getParent().getName()
                if parent.startswith(f"{BUCKET}="):
                    bucket = parent.removeprefix(f"{BUCKET}=")
                    found[bucket] = found.get(bucket, 0) + status.getLen()
        return found


def _version(name: str) -> int:
    return int(name.split(".")[0])


def state(spark: SparkSession, path: str) -> State:
    """From the last checkpoint of the log, and the commits after it."""
    files, out = _Files(spark, path), State()
    names = files.names("log")
    checkpoints = [n for n in names if n.endswith(".all.json")]
    if checkpoints:
        whole = files.read(f"log/{checkpoints[-1]}")
        out = State(whole["version"], whole["last_batch"], whole["buckets"], [Run(*r) for r in whole["runs"]])
    for name in names:
        if name.endswith(".commit.json") and _version(name) > out.version:
            out.apply(files.read(f"log/{name}"))
    return out


def _commit(files: _Files, now: State, batch: int, add: list[Run], drop: list[Run], split: list[str]) -> None:
    body = {
        "version": now.version + 1, "batch": batch, "add": [[r.bucket, r.folder, r.level, r.bytes] for r in add],
        "drop": [[r.bucket, r.folder] for r in drop], "split": split}
    files.write(f"log/{body['version']:012d}.commit.json", body)
    now.apply(body)
    if now.version % CHECKPOINT == CHECKPOINT - 1:
        files.write(f"log/{now.version:012d}.all.json", {
            "version": now.version, "last_batch": now.last_batch, "buckets": now.buckets,
            "runs": [[r.bucket, r.folder, r.level, r.bytes] for r in now.runs]})


def _read(spark: SparkSession, path: str, runs: list[Run], schema: T.StructType) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[r.path(path) for r in runs])


def _schema(files: _Files) -> T.StructType:
    return T.StructType.fromJson(files.read("schema.json"))


def compact_table(
    spark: SparkSession, path: str, keys: list[str], sequence: list[str], fan_in: int = FAN_IN, bucket_bytes: int = BUCKET_BYTES
) -> bool:
    """One round of compaction: of each bucket the lowest level that is full; all of a bucket that is too large, in halves.

    Returns whether there was anything to do. Runs that it merges are no longer live, and stay until ``vacuum``.
    """
    files = _Files(spark, path)
    now = state(spark, path)
    by_bucket: dict[str, list[Run]] = {}
    for r in now.runs:
        by_bucket.setdefault(r.bucket, []).append(r)
    merge, split, level = [], [], {}
    for bucket, runs in by_bucket.items():
        if sum(r.bytes for r in runs) > bucket_bytes:
            split.append(bucket)
            merge += runs
            level |= dict.fromkeys(_halves(bucket), max(r.level for r in runs))
            continue
        for at in sorted({r.level for r in runs}):
            full = [r for r in runs if r.level == at]
            if len(full) >= fan_in:
                merge += full
                level[bucket] = at + 1
                break
    if not merge:
        return False
    gone = set(split)
    buckets = [b for b in now.buckets if b not in gone] + [half for b in split for half in _halves(b)]
    rows = latest_changes(_read(spark, path, merge, _schema(files)), keys, sequence)
    folder = f"compacted-{uuid.uuid4().hex}"
    with_bucket(rows, keys, buckets).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/rows/{folder}")
    add = [Run(b, folder, level[b], size) for b, size in sorted(files.sizes(f"rows/{folder}").items())]
    _commit(files, now, -1, add, merge, split)
    return True


def apply_to_table(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], sequence: list[str], fan_in: int = FAN_IN,
    bucket_bytes: int = BUCKET_BYTES, compact: bool = True,
) -> None:
    """Appends every batch of the feed as a delta; with ``compact`` levels that are full are merged after each."""
    spark = stream.sparkSession
    if not folder_exists(spark, f"{path}/schema.json"):
        names = [*keys, *[c for c in stream.columns if c not in keys]]
        _Files(spark, path).write("schema.json", T.StructType([stream.schema[c] for c in names]).jsonValue())

    def batch(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        files, now = _Files(session, path), state(session, path)
        if batch_id > now.last_batch:
            folder = f"batch-{batch_id}-{uuid.uuid4().hex}"
            fresh = with_bucket(latest_changes(rows, keys, sequence), keys, now.buckets)
            balanced(fresh, BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/rows/{folder}")
            _commit(files, now, batch_id, [Run(b, folder, 0, n) for b, n in sorted(files.sizes(f"rows/{folder}").items())], [], [])
        while compact and compact_table(session, path, keys, sequence, fan_in, bucket_bytes):
            pass

    run_batches(stream, batch, checkpoint)


def table_state(spark: SparkSession, path: str, keys: list[str], sequence: list[str], is_delete: Column) -> DataFrame:
    """The rows of all keys whose last change is no delete. A table that no batch has reached yet is empty."""
    now, schema = state(spark, path), _schema(_Files(spark, path))
    several = {b for b in now.buckets if sum(r.bucket == b for r in now.runs) > 1} if len(now.runs) > len({r.bucket for r in now.runs}) else set()
    whole = _read(spark, path, [r for r in now.runs if r.bucket not in several], schema)
    merged = [r for r in now.runs if r.bucket in several]
    if merged:
        whole = whole.unionByName(latest_changes(_read(spark, path, merged, schema), keys, sequence))
    return whole.filter(~is_delete)


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes folders of rows in which nothing is live, and commits before the last checkpoint; returns how many folders went.

    Readers that began before may still use what goes: run it when they are done.
    """
    files = _Files(spark, path)
    live = {r.folder for r in state(spark, path).runs}
    gone = [f for f in files.names("rows") if f not in live]
    for folder in gone:
        files.delete(f"rows/{folder}")
    names = files.names("log")
    last = max((_version(n) for n in names if n.endswith(".all.json")), default=-1)
    for name in names:
        if not name.startswith(".") and (_version(name) < last or (_version(name) == last and name.endswith(".commit.json"))):
            files.delete(f"log/{name}")
    return len(gone)
