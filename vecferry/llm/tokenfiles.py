"""Token ids in binary shards with a minimal perfect hash index.

File format, one Parquet row per shard: ``payload`` has the raw ids of the shard's documents one after another, unsigned
little-endian integers of ``width`` bytes; ``starts`` where each document begins, and the end (int64, in ids); ``keys``
their ``doc_id`` in ascending order (int64) and ``keyless`` how many documents with a null ``doc_id`` come first.
``levels`` and ``bits`` are the minimal perfect hash: bit arrays, one after another; a key takes its bit in the first
level where no other key of that level wants it, and its slot is the number of bits set before. ``fingerprints`` and
``places`` are by slot: 32 bits of another hash of the key, and the document's number in the shard. Looking up a key
costs a few probes and no search; a key that is not there is told by its fingerprint.

For scale: texts are sorted by ranges of ``doc_id`` (ties by text), once; each task writes shards of ``shard_ids`` ids,
so memory is bounded by a shard or one document. Spark's writer commits the shards, so lost tasks leave nothing behind.
The place of a shard among all ids is a sum over shards, taken per task first.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vecferry.llm import tokens
from vecferry.llm.common import sliced, texts
from vecferry.session import work_path

END = 2
VOCABULARY = "byte_bpe_50k.json"
SHARD_IDS = 1 << 19
SLICE = 1 << 22  # bytes of text that are encoded at once, or one text
ROOM = 2  # bits per key and level
MOST_LEVELS = 64

SHARD = (
    "shard long, first_key long, last_key long, n_docs long, n_ids long, width int, keyless long, payload binary, "
    "starts binary, keys binary, levels binary, bits binary, fingerprints binary, places binary")


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits per level, all bits) of a minimal perfect hash of distinct keys."""
    levels, arrays, rest = [], [], keys
    while len(rest):
        if len(levels) == MOST_LEVELS:
            raise ValueError("keys are not distinct")
        size = ROOM * len(rest) + 1
        at = (mixed(rest, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(size)
        arrays.append(alone)
        rest = rest[~alone[at]]
    return np.array(levels, np.int64), np.concatenate(arrays) if arrays else np.zeros(0, bool)


def slots(keys: np.ndarray, levels: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 where no level has one."""
    before = np.concatenate([[0], np.cumsum(bits)])
    out, rest, first = np.full(len(keys), -1), np.arange(len(keys)), 0
    for level, size in enumerate(levels.tolist()):
        at = first + (mixed(keys[rest], level) % np.uint64(size)).astype(np.int64)
        hit = bits[at]
        out[rest[hit]] = before[at[hit]]
        rest, first = rest[~hit], first + size
    return out


def _shard(name: int, keys: list, ids: list[bytes], width: int) -> tuple:
    """One row of the file format; ``keys`` ascend, nulls first."""
    keyless = sum(k is None for k in keys)
    known = np.array(keys[keyless:], np.int64)
    distinct, place = np.unique(known, return_index=True)  # of a repeated key the first document
    levels, bits = build_hash(distinct)
    slot = slots(distinct, levels, bits)
    fingerprints, places = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.int64)
    fingerprints[slot] = (mixed(distinct, MOST_LEVELS) >> np.uint64(32)).astype(np.uint32)
    places[slot] = place + keyless
    starts = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int64)
    payload = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}").tobytes()
    ends = (int(known[0]), int(known[-1])) if len(known) else (None, None)
    return (
        name, *ends, len(keys), int(starts[-1]), width, keyless, payload, starts.tobytes(), known.tobytes(), levels.tobytes(),
        np.packbits(bits).tobytes(), fingerprints.tobytes(), places.tobytes())


KINDS = [pa.int64()] * 5 + [pa.int32(), pa.int64()] + [pa.binary()] * 7
NAMES = [c.split()[0] for c in SHARD.split(", ")]


def write_token_files(documents: DataFrame, path: str, vocabulary: str | None = None, end: int = END, shard_ids: int = SHARD_IDS) -> None:
    """Writes the ids of all documents in ascending ``doc_id`` order (nulls first, ties by text). A null text is empty."""
    model = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(model, True)
        width = 2 if encode.tokenizer.get_vocab_size() <= 1 << 16 else 4
        stop = np.array([end], "<u4").tobytes()
        name, keys, ids, size = TaskContext.get().partitionId() << 32, [], [], 0

        def close() -> pa.RecordBatch:
            row = _shard(name, keys, ids, width)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, KINDS, strict=True)], names=NAMES)

        for batch in sliced(batches, SLICE):
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encode.several(batch.column("text")), strict=True):
                keys.append(doc_id)
                ids.append(found + stop)
                size += len(ids[-1]) // 4
                if size >= shard_ids:
                    yield close()
                    name, keys, ids, size = name + 1, [], [], 0
            encode.trim()
        if keys:
            yield close()

    ordered = texts(documents).repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    shards = ordered.mapInArrow(run, SHARD)
    shards.write.option("compression", "uncompressed").option("parquet.block.size", 16 << 20).parquet(path)


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    levels = np.frombuffer(row["levels"], np.int64)
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(levels.sum())).astype(bool)
    return (
        np.frombuffer(row["payload"], f"<u{row['width']}"), np.frombuffer(row["starts"], np.int64), levels, bits,
        np.frombuffer(row["fingerprints"], np.uint32), np.frombuffer(row["places"], np.int64))


def find(keys: np.ndarray, levels: np.ndarray, bits: np.ndarray, fingerprints: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number in the shard of each key's document, -1 where the index has no such key."""
    if not len(fingerprints):
        return np.full(len(keys), -1)
    slot = slots(keys, levels, bits)
    known = (slot >= 0) & (fingerprints[slot] == (mixed(keys, MOST_LEVELS) >> np.uint64(32)).astype(np.uint32))
    return np.where(known, places[slot], -1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A row per document, from the files: ``doc_id, start, n_tokens, ids_crc32``; each key goes through the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            payload, starts, levels, bits, fingerprints, places = _read(row)
            keys = np.frombuffer(row["keys"], np.int64)
            number = find(keys, levels, bits, fingerprints, places)
            if (number < 0).any():
                raise ValueError(f"shard {row['shard']}: a key is not in its index")
            again = np.concatenate([[False], keys[1:] == keys[:-1]])[: len(keys)]
            number = np.where(again, np.arange(len(keys)) + row["keyless"], number)  # further documents of a key follow the first
            number = np.concatenate([np.arange(row["keyless"]), number])
            sums = [crc32(payload[a:b].astype("<u4").tobytes()) for a, b in zip(starts[number].tolist(), starts[number + 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array([None] * row["keyless"] + keys.tolist(), pa.int64()), pa.array(np.full(len(number), row["shard"])),
                pa.array(starts[number]), pa.array(starts[number + 1] - starts[number]), pa.array(sums, pa.int64()),
            ], names=["doc_id", "shard", "at", "n_tokens", "ids_crc32"])

    files = spark.read.schema(SHARD).parquet(path)
    found = files.mapInArrow(run, "doc_id long, shard long, at long, n_tokens long, ids_crc32 long")
    sizes = files.select("shard", "n_ids", F.shiftright("shard", 32).alias("task"))
    tasks = sizes.groupBy("task").agg(F.sum("n_ids").alias("n"))
    tasks = tasks.select(F.col("task").alias("_task"), (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("base"))
    within = F.sum("n_ids").over(Window.partitionBy("task").orderBy("shard")) - F.col("n_ids")
    bases = sizes.withColumn("within", within).join(tasks, F.col("task") == F.col("_task"))
    bases = bases.select(F.col("shard").alias("_shard"), (F.col("base") + F.col("within")).alias("base"))
    met = found.join(bases, F.col("shard") == F.col("_shard"))
    return met.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """``doc_id, ids`` of the given keys, a list that the caller holds; keys that are not there give no row."""
    wanted = np.unique(np.array(keys, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            payload, starts, *index = _read(row)
            here = wanted[(wanted >= row["first_key"]) & (wanted <= row["last_key"])]
            number = find(here, *index)
            got = [(k, payload[starts[n] : starts[n + 1]].tolist()) for k, n in zip(here.tolist(), number.tolist(), strict=True) if n >= 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in got], pa.int64()), pa.array([i for _, i in got], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    low, high = (int(wanted[0]), int(wanted[-1])) if len(wanted) else (1, 0)
    files = spark.read.schema(SHARD).parquet(path).filter((F.col("last_key") >= low) & (F.col("first_key") <= high))
    return files.mapInArrow(run, "doc_id long, ids array<long>")


def token_files(documents: DataFrame, vocabulary: str | None = None, shard_ids: int = SHARD_IDS, path: str | None = None) -> DataFrame:
    """Writes the files and reads them back: a row per document, ``doc_id, start, n_tokens, ids_crc32``.

    ``n_tokens`` counts the end id. Repeated rows are written each; the index leads to the first of a key, the others
    follow it. A null ``doc_id`` has no key and is read in sequence. An empty table gives no rows.
    """
    path = path or work_path(documents.sparkSession, "token-files")
    write_token_files(documents, path, vocabulary, shard_ids=shard_ids)
    return read_documents(documents.sparkSession, path)
