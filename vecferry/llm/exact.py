"""Exact duplicates by an extendible-hash index on shared files.

The index keeps every distinct text once, below its 64-bit key. Its directory has ``2 ** depth`` slots, addressed by the
leading bits of the key; each slot points to a bucket, whose rows lie together in one file. A bucket with more keys
than ``bucket_rows`` is split by one more bit, and where its own depth has reached that of the directory, the directory
doubles first. One owner task per bucket walks its key range in order, chains the texts that share a key and compares
their bytes, so two texts are equal only when all their bytes are.

For scale: copies are combined where they are read, so a text that a third of all rows hold reaches its owner a few
times per task, not once per row. The driver holds the directory alone, ``2 ** max_depth`` slots at most; beyond that
buckets grow, and their owners stream them. Texts are shuffled once; rows are matched to their group by key and digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vecferry.llm.common import keep, returning, sha256_hex, texts, written
from vecferry.session import work_path

HELD_BYTES = 48 << 20  # texts that a reading task holds while it combines copies
MOST_DEPTH = 16


@dataclass(frozen=True)
class Directory:
    """``slots[prefix]`` is the bucket of the keys whose first ``depth`` bits are ``prefix``."""

    depth: int
    slots: list[int]
    depths: list[int]  # by bucket


def build_directory(counts: dict[int, int], bits: int, bucket_rows: int) -> Directory:
    """Splits overfull buckets; ``counts`` has the number of keys per leading ``bits`` bits, the greatest depth."""
    depth, slots, depths, prefixes = 0, [0], [0], [0]
    open_buckets = [0]

    def keys_in(bucket: int) -> int:
        rest = bits - depths[bucket]
        first = prefixes[bucket] << rest
        return sum(counts.get(p, 0) for p in range(first, first + (1 << rest))) if rest < 8 else sum(
            n for p, n in counts.items() if p >> rest == prefixes[bucket])

    while open_buckets:
        bucket = open_buckets.pop()
        if depths[bucket] == bits or keys_in(bucket) <= bucket_rows:
            continue
        if depths[bucket] == depth:
            slots = [b for b in slots for _ in range(2)]  # doubling: each slot becomes two
            depth += 1
        depths[bucket] += 1
        prefixes[bucket] <<= 1
        new = len(depths)
        depths.append(depths[bucket])
        prefixes.append(prefixes[bucket] | 1)
        width = 1 << (depth - depths[new])
        slots[prefixes[new] * width : (prefixes[new] + 1) * width] = [new] * width
        open_buckets += [bucket, new]
    return Directory(depth, slots, depths)


ENTRY = "key long, digest binary, text string, last long, has_null boolean, n long"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of one task become one row, as far as ``HELD_BYTES`` reach; the rest meet at the owner."""
    held: dict = {}
    size = 0

    def flush() -> pa.RecordBatch:
        rows = [(k, d, t, *v) for (k, t), (d, *v) in held.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = (pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.bool_(), pa.int64())
        names = ("key", "digest", "text", "last", "has_null", "n")
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for key, digest, text, last, has_null, n in zip(*columns, strict=True):
            found = held.get((key, text))
            if found is None:
                held[key, text] = [digest, last, has_null, n]
                size += len(text) * 2 + 200
            else:
                found[1] = last if found[1] is None else found[1] if last is None else max(found[1], last)
                found[2] |= has_null
                found[3] += n
        if size > HELD_BYTES:
            yield flush()
            held.clear()
            size = 0
    if held:
        yield flush()


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by bucket and key: one chain per key at a time, its members told apart by their bytes."""
    out: list[tuple] = []
    at, chain = None, []

    def close() -> None:
        out.extend((*at, digest, text, last, has_null, n) for text, digest, last, has_null, n in chain)

    def table() -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.bool_(), pa.int64())
        names = ["bucket", "key", "digest", "text", "last", "has_null", "n"]
        columns = list(zip(*out, strict=True)) if out else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    size = 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for bucket, key, digest, text, last, has_null, n in zip(*columns, strict=True):
            if at != (bucket, key):
                if at is not None:
                    close()
                at, chain = (bucket, key), []
            member = next((m for m in chain if m[0] == text), None)
            if member is None:
                chain.append([text, digest, last, has_null, n])
                size += len(text)
            else:
                member[2] = last if member[2] is None else member[2] if last is None else max(member[2], last)
                member[3] |= has_null
                member[4] += n
            if size > HELD_BYTES // 4 and out:
                yield table()
                out, size = [], 0
    if at is not None:
        close()
        yield table()


def build_index(documents: DataFrame, bucket_rows: int = 10_000, key: Column | None = None) -> tuple[DataFrame, DataFrame, Directory]:
    """(entries, index, directory): a row per document with its key and digest, and a row per distinct text.

    ``key`` overrides the 64-bit key of the column ``text``; equal texts must have equal keys.
    """
    spark = documents.sparkSession
    key = F.xxhash64("text") if key is None else key
    keyed = texts(documents).withColumn("key", key).withColumn("digest", F.unhex(sha256_hex(F.col("text"))))
    entries = written(keyed.select("doc_id", "key", "digest"), "entries")
    slot = F.shiftrightunsigned("key", 64 - MOST_DEPTH).cast("int")
    counts = {r[0]: r[1] for r in entries.select("key").distinct().groupBy(slot).count().collect()}  # 2 ** 16 at most
    directory = build_directory(counts, MOST_DEPTH, bucket_rows)
    by_slot = spark.createDataFrame(
        [(p, directory.slots[p >> (MOST_DEPTH - directory.depth)]) for p in counts], "slot int, bucket int")
    combined = keyed.select(
        "key", "digest", "text", F.col("doc_id").alias("last"), F.col("doc_id").isNull().alias("has_null"), F.lit(1).cast("long").alias("n"),
    ).mapInArrow(returning(_combine), ENTRY)
    owned = (
        combined.withColumn("slot", slot).join(F.broadcast(by_slot), "slot")  # 2 ** 16 small rows at most
        .select("bucket", "key", "digest", "text", "last", "has_null", "n")
        .repartition("bucket").sortWithinPartitions("bucket", "key")
        .mapInArrow(returning(_own), f"bucket int, {ENTRY}")
    )
    path = work_path(spark, "index")
    owned.write.option("compression", "zstd").parquet(path)
    return entries, spark.read.schema(f"bucket int, {ENTRY}").parquet(path), directory


def exact_groups(documents: DataFrame, bucket_rows: int = 10_000, key: Column | None = None) -> DataFrame:
    """A row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the largest ``doc_id`` stays; a null ``doc_id`` stays only where all of the group are null. Texts
    are compared unchanged; null counts as empty. Rows that repeat a ``doc_id`` with its text are one document listed
    twice: they count in ``group_size`` and carry the same answer. An empty table gives no rows.
    """
    entries, index, _ = build_index(documents, bucket_rows, key)
    groups = index.select(
        F.col("key").alias("_key"), F.col("digest").alias("_digest"), F.col("last").alias("keep_id"), F.col("n").alias("group_size"))
    met = entries.join(groups, (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest")), "left")
    return met.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(documents: DataFrame, bucket_rows: int = 10_000) -> DataFrame:
    """The documents that stay, all their columns. Every row of a ``doc_id`` that stays is returned."""
    return keep(documents, exact_groups(documents, bucket_rows).filter("kept"))
