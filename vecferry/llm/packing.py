"""Best-fit packing of token sequences with large-item matching.

Pieces above a third of the capacity fit at most twice into a sequence: they are matched greedily, the longest with the
longest that still fits beside it. The others, longest first, go where the least room that suffices is left. Whether a
piece fits depends on its length alone, so the plan is made on counts per length: all pieces of a length that go to like
sequences are one run (length, ranks, first sequence, pieces per sequence, offset). There are at most as many lengths as
the capacity has tokens, and each run uses up a length or a set of sequences, whose room more than halves; the number of
runs is bounded by the capacity, not by the documents.

For scale: texts are encoded where they are read. A piece's rank among those of its length is its rank in its task plus
the counts of the tasks before, which a window per length sums up over tasks, not over pieces. Pieces then look up their
run in a bounded table. Only lengths and ranks are shuffled, no texts and no ids.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vecferry.llm import tokens
from vecferry.llm.common import returning, sliced, texts, written

CAPACITY = 2048
END = 0
SLAB_BYTES = 4 << 20  # of text that a task holds as Python objects at once
VOCABULARY = "word_bpe_49k.json"

Run = tuple[int, int, int, int, int, int]  # length, first rank, pieces, first sequence, pieces per sequence, offset


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Runs for ``counts`` pieces per length, and the number of sequences."""
    left = {length: n for length, n in counts.items() if n}
    rank: Counter = Counter()
    runs: list[Run] = []
    rooms: dict[int, list[tuple[int, int]]] = {}  # by room left: (first sequence, sequences)
    sequences = 0

    def put(length: int, first: int, n_sequences: int, each: int, offset: int) -> None:
        runs.append((length, rank[length], n_sequences * each, first, each, offset))
        rank[length] += n_sequences * each
        left[length] -= n_sequences * each

    def free(room: int, first: int, n: int) -> None:
        if room and n:
            rooms.setdefault(room, []).append((first, n))

    large = sorted((length for length in left if 3 * length > capacity), reverse=True)
    for length in large:
        while left[length]:
            mate = next((m for m in large if m <= capacity - length and left[m] > (m == length)), None)
            n = left[length] if mate is None else left[length] // 2 if mate == length else min(left[length], left[mate])
            first, room = sequences, capacity - length
            sequences += n
            if mate == length:
                put(length, first, n, 2, 0)
                room -= length
            else:
                put(length, first, n, 1, 0)
                if mate is not None:
                    put(mate, first, n, 1, length)
                    room -= mate
            free(room, first, n)
    for length in sorted((length for length in left if 3 * length <= capacity), reverse=True):
        room = length
        while left[length]:
            room = next((r for r in range(room, capacity + 1) if rooms.get(r)), 0)
            if room:
                first, n = rooms[room].pop()
            else:
                room, first = capacity, sequences
                n = -(-left[length] // (capacity // length))
                sequences += n
            each = min(room // length, left[length])
            full = min(n, left[length] // each)
            put(length, first, full, each, capacity - room)
            free(room - each * length, first, full)
            some = left[length] if full < n and left[length] else 0
            if some:  # the last sequence that gets any, and fewer than there is room for
                put(length, first + full, 1, some, capacity - room)
                free(room - some * length, first + full, 1)
            free(room, first + full + bool(some), n - full - bool(some))
    return runs, sequences


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"


def pieces(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of each document and its end token, ranked within task and length.

    ``with_ids`` adds ``ids``, little-endian unsigned 32-bit integers.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ranks = TaskContext.get().partitionId(), Counter()
        encode = tokens.encoder(path, False)
        end, step = np.array([END], "<u4").tobytes(), 4 * capacity
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for batch in batches:
            for slab in sliced([batch], SLAB_BYTES):
                rows = []
                for doc_id, text in zip(slab.column("doc_id").to_pylist(), slab.column("text").to_pylist(), strict=True):
                    ids = encode.ids(text) + end
                    for number, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        length = len(part) // 4
                        rows.append((doc_id, number, at // 4, length, crc32(part), task, ranks[length], *([part] if with_ids else [])))
                        ranks[length] += 1
                names = [c.split()[0] for c in PIECE.split(", ")] + ["ids"] * with_ids
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds + [pa.binary()] * with_ids, strict=True)], names=names)
            encode.trim()

    return texts(documents).mapInArrow(returning(run, encoders=True), PIECE + ", ids binary" * with_ids)


def pack(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    A document is its ids and one end token; only documents longer than ``capacity`` are cut. A null or empty text is
    its end token alone. Repeated rows are packed each. Within a sequence pieces lie without gaps from offset 0. An
    empty table gives no rows.
    """
    cut = written(pieces(documents, vocabulary, capacity, with_ids), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    per_task = written(per_task.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")), "piece-counts")
    counts = {r[0]: r[1] for r in per_task.groupBy("length").agg(F.sum("n")).collect()}  # a row per length
    runs, _ = plan(counts, capacity)
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, 6)
    shared = documents.sparkSession.sparkContext.broadcast(table)  # bounded by the capacity

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, sequence, each, offset = shared.value.T
        key = length << 44 | first
        for batch in batches:
            rank = batch.column("rank").to_numpy() + batch.column("base").to_numpy()
            of = batch.column("length").to_numpy()
            at = np.searchsorted(key, of << 44 | rank, "right") - 1
            step = rank - first[at]
            out = {n: batch.column(n) for n in kept}
            out["sequence_id"] = pa.array(sequence[at] + step // each[at])
            out["offset"] = pa.array(offset[at] + step % each[at] * of)
            yield pa.RecordBatch.from_pydict(out)

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    bases = per_task.select(F.col("length").alias("_length"), F.col("task").alias("_task"), "base")
    ranked = cut.join(bases, (F.col("length") == F.col("_length")) & (F.col("task") == F.col("_task"))).select(*kept, "rank", "base")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: whole sequences, from ``pack(..., with_ids=True)``."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("length"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))
