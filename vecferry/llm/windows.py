"""Windows of fixed length that repeat, found with super-k-mers; shared by the word and the byte operator.

A window's minimiser is the least hash of the grams in it. Equal windows have equal minimisers, so a window whose
minimiser occurs once in all documents repeats nowhere. Consecutive windows that share a minimiser travel as one packed
string (a super-k-mer), and only those whose minimiser occurs again travel at all. Equal strings are combined before they
are shuffled; a group is the distinct strings of one minimiser, and windows are compared within their group.

For scale: first the minimisers alone are counted, a few bytes for dozens of windows; what travels as text is the part
of the corpus that repeats. A group of more than ``few`` strings or ``small`` bytes, what a task can hold, is not gathered:
it is dealt to chunks of that size, and the distinct windows of each meet as 128-bit digests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vecferry.llm.common import texts, written

FEW, SMALL = 8000, 1 << 21
HELD = 8 << 20
LAST = (1 << 63) - 1
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Words:
    """Units are words; ``gram`` words make a gram."""

    size: int = 50
    gram: int = 8

    def units(self, body: bytes) -> list[bytes]:
        return body.split()

    def hashes(self, units: list[bytes]) -> np.ndarray:
        c = np.fromiter(map(crc32, units), np.uint64, len(units))
        n = len(c) - self.gram + 1
        h = np.zeros(n, np.uint64)
        for j in range(self.gram):
            h = (h ^ c[j : j + n]) * K1
            h ^= h >> np.uint64(29)
        return h

    def packed(self, units: list[bytes], first: int, n: int) -> bytes:
        return b" ".join(units[first : first + n + self.size - 1])

    def cut(self, packed: bytes) -> list[bytes]:
        """All windows of a packed string."""
        at = [0, *(np.flatnonzero(np.frombuffer(packed, np.uint8) == 32) + 1).tolist(), len(packed) + 1]
        return [packed[at[i] : at[i + self.size] - 1] for i in range(len(at) - self.size)]


@dataclass(frozen=True)
class Bytes:
    """Units are bytes; a gram has 32."""

    size: int = 200
    gram: int = 32

    def units(self, body: bytes) -> bytes:
        return body

    def hashes(self, units: bytes) -> np.ndarray:
        w = eights(units)
        n = len(units) - self.gram + 1
        h = np.zeros(n, np.uint64)
        for j in range(0, self.gram, 8):
            h = (h ^ w[j : j + n]) * K1
            h ^= h >> np.uint64(29)
        return h * K2

    def packed(self, units: bytes, first: int, n: int) -> bytes:
        return units[first : first + n + self.size - 1]

    def cut(self, packed: bytes) -> list[bytes]:
        return [packed[i : i + self.size] for i in range(len(packed) - self.size + 1)]


def eights(body: bytes) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    out = np.empty(len(body) - 7, np.uint64)
    for r in range(min(8, len(out))):
        n = (len(body) - r) // 8
        out[r::8] = np.frombuffer(body, "<u8", n, r)
    return out


def super_kmers(h: np.ndarray, grams: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, minimiser) of each run; ``grams`` is how many grams a window has."""
    least, width = h, 1
    while 2 * width <= grams:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if grams > width:
        least = np.minimum(least[: len(h) - grams + 1], least[grams - width : len(h) - width + 1])
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    return first, np.diff(np.concatenate([first, [len(least)]])), least[first]


def again_within(h: np.ndarray, grams: int, first: np.ndarray, n: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether the minimiser of a run lies at more than one place of the run's span."""
    at = np.arange(grams)
    out = np.zeros(len(first), bool)
    for a in range(0, len(first), 4096):
        f, last, v = first[a : a + 4096], (first + n - 1)[a : a + 4096], value[a : a + 4096, None]
        leftmost = f + np.argmax(h[f[:, None] + at] == v, axis=1)
        rightmost = last + grams - 1 - np.argmax(h[last[:, None] + at[::-1]] == v, axis=1)
        out[a : a + 4096] = leftmost != rightmost
    return out


def _runs(unit, body: bytes):
    units = unit.units(body)
    if len(units) < unit.size:
        return None
    h = unit.hashes(units)
    return units, h, super_kmers(h, unit.size - unit.gram + 1)


def keyed(documents: DataFrame) -> DataFrame:
    """``doc_id, text, uid``; rows with the same identifier and text have the same ``uid``."""
    return texts(documents).withColumn("uid", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"))


def minimisers(documents: DataFrame, unit, within: bool) -> DataFrame:
    """``uid, doc, value, n``: the minimisers of each document; ``within`` counts one twice that a run has twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts, owners = [], [], []
            for i, body in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                found = _runs(unit, body)
                if found is None:
                    continue
                _, h, (first, n, value) = found
                times = 1 + again_within(h, unit.size - unit.gram + 1, first, n, value) if within else np.ones(len(value), np.int64)
                distinct, of = np.unique(value, return_inverse=True)
                values.append(distinct.view(np.int64))
                counts.append(np.bincount(of, times).astype(np.int64))
                owners.append(np.full(len(distinct), i))
            if values:
                at = pa.array(np.concatenate(owners))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("uid").take(at), batch.column("doc").take(at), pa.array(np.concatenate(values)), pa.array(np.concatenate(counts))],
                    names=["uid", "doc", "value", "n"])

    rows = documents.select("text", "uid", F.coalesce("doc_id", F.lit(LAST)).alias("doc"))
    return rows.mapInArrow(run, "uid long, doc long, value long, n long")


def occurrences(documents: DataFrame, unit, repeated: DataFrame) -> DataFrame:
    """``uid, doc, first, n, value, packed``: the super-k-mers whose minimiser is in ``repeated`` (``uid, value``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["uid", "doc", "first", "n", "value", "packed"])

        for batch in batches:
            rows, size = [], 0
            bodies, wanted = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("values")
            for i, body in enumerate(bodies):
                units, _, (first, n, value) = _runs(unit, body)
                hit = np.isin(value.view(np.int64), wanted[i].values.to_numpy())
                uid, doc = batch.column("uid")[i].as_py(), batch.column("doc")[i].as_py()
                for f, k, v in zip(first[hit].tolist(), n[hit].tolist(), value[hit].view(np.int64).tolist(), strict=True):
                    rows.append((uid, doc, f, k, v, unit.packed(units, f, k)))
                    size += len(rows[-1][-1])
                if size > HELD:
                    yield table(rows)
                    rows, size = [], 0
            yield table(rows)

    lists = repeated.groupBy("uid").agg(F.collect_list("value").alias("values")).withColumnRenamed("uid", "_uid")
    rows = documents.select("text", "uid", F.coalesce("doc_id", F.lit(LAST)).alias("doc"))
    met = rows.join(lists, F.col("uid") == F.col("_uid")).select("text", "uid", "doc", "values")
    return met.mapInArrow(run, "uid long, doc long, first int, n int, value long, packed binary")


Judge = Callable[[list[tuple[bytes, int, int]]], list[list[tuple[int, int, int]]]]


def judged(strings: DataFrame, unit, judge: Judge, combine: str, alone: str, few: int = FEW, small: int = SMALL) -> DataFrame:
    """``digest, parts``: for each distinct string the runs (first window, windows, mark) of its windows.

    ``strings`` has ``value, packed, digest, n, lo, times``. The mark of a window is ``min`` of ``lo`` or ``sum`` of
    ``times`` over all windows equal to it. ``judge`` does that for whole groups that fit into memory; where ``alone``
    holds, a string that is its whole group needs no comparison, and its windows have the mark of the string.
    """
    sizes = strings.groupBy("value").agg(F.count("*").alias("strings"), F.sum(F.length("packed")).alias("bytes"))
    every = written(strings.join(sizes, "value"), "sized")
    plain = (F.col("strings") == 1) & F.expr(alone)
    mark = "lo" if combine.startswith("min") else "times"
    whole = every.filter(plain).select("digest", F.array(F.struct(F.lit(0).alias("at"), "n", F.col(mark).alias("mark"))).alias("parts"))
    sized = every.filter(~plain)
    fits = (F.col("strings") <= few) & (F.col("bytes") <= small)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: list[tuple] = []
        size = 0

        def judge_held() -> pa.RecordBatch:
            parts = judge([(p, lo, times) for _, p, lo, times in held])
            return pa.RecordBatch.from_arrays([
                pa.array([d for d, *_ in held], pa.binary()),
                pa.array([[{"at": a, "n": n, "mark": m} for a, n, m in p] for p in parts], PART),
            ], names=["digest", "parts"])

        at = None
        for batch in batches:
            for value, *row in zip(*(batch.column(c).to_pylist() for c in ("value", "digest", "packed", "lo", "times")), strict=True):
                if value != at:
                    held += group
                    group, at = [], value
                    if size > small:
                        yield judge_held()
                        held, size = [], 0
                group.append(tuple(row))
                size += len(row[1])
        held += group
        if held:
            yield judge_held()

    gathered = sized.filter(fits).repartition("value").sortWithinPartitions("value")
    gathered = gathered.select("value", "digest", "packed", "lo", "times").mapInArrow(together, JUDGED)

    # Larger groups are dealt to chunks that fit. A chunk first sends each of its distinct windows once, with what it has
    # of the mark; the marks of all chunks are put together by window, and each chunk reads those of its windows again.
    chunks = F.greatest(F.ceil(F.col("strings") / few), F.ceil(F.col("bytes") / small)).cast("int")
    large = sized.filter(~fits).withColumn("chunk", F.pmod(F.xxhash64("digest"), chunks))
    large = large.select("value", "chunk", "digest", "packed", "lo", "times")

    def digests(packed: bytes) -> list[bytes]:
        return [xxhash.xxh3_128_digest(w) for w in unit.cut(packed)]

    def send(rows: pa.Table) -> pa.Table:
        found: dict[bytes, list[int]] = {}
        for packed, lo, times in zip(*(rows.column(c).to_pylist() for c in ("packed", "lo", "times")), strict=True):
            for window in digests(packed):
                mark = found.setdefault(window, [lo, 0])
                mark[0] = min(mark[0], lo)
                mark[1] += times
        n = len(found)
        return pa.table({
            "value": pa.array(rows.column("value").to_pylist()[:1] * n, pa.int64()), "chunk": pa.array(rows.column("chunk").to_pylist()[:1] * n, pa.int64()),
            "window": pa.array(list(found), pa.binary()), "lo": pa.array([m[0] for m in found.values()], pa.int64()),
            "times": pa.array([m[1] for m in found.values()], pa.int64())})

    def receive(rows: pa.Table, marks: pa.Table) -> pa.Table:
        known = dict(zip(marks.column("window").to_pylist(), marks.column("mark").to_pylist(), strict=True))
        parts = [as_runs([known[w] for w in digests(packed)]) for packed in rows.column("packed").to_pylist()]
        return pa.table({
            "digest": pa.array(rows.column("digest").to_pylist(), pa.binary()),
            "parts": pa.array([[{"at": a, "n": n, "mark": m} for a, n, m in p] for p in parts], PART)})

    sent = written(large.groupBy("value", "chunk").applyInArrow(send, "value long, chunk long, window binary, lo long, times long"), "window-marks")
    marks = sent.groupBy("window").agg(F.expr(f"{combine} AS mark"))
    back = sent.join(marks, "window").select("value", "chunk", "window", "mark")
    single = large.groupBy("value", "chunk").cogroup(back.groupBy("value", "chunk")).applyInArrow(receive, JUDGED)
    return whole.unionByName(gathered).unionByName(single)


PART = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("mark", pa.int64())]))
JUDGED = "digest binary, parts array<struct<at: int, n: int, mark: long>>"


def as_runs(marks: list[int]) -> list[tuple[int, int, int]]:
    """Neighbouring windows with the same mark as one run."""
    out: list[list[int]] = []
    for i, mark in enumerate(marks):
        if out and out[-1][2] == mark:
            out[-1][1] += 1
        else:
            out.append([i, 1, mark])
    return [tuple(r) for r in out]


def covered(documents: DataFrame, unit, judge: Judge, within: bool, repeats: str, combine: str, alone: str, goes: str, few: int = FEW, small: int = SMALL) -> DataFrame:
    """``uid, spans``: the units of each document that windows which go cover, as (start, end) spans.

    ``repeats`` says on the aggregates ``lo``, ``hi``, ``total`` which minimisers can repeat; ``alone`` as in ``judged``;
    ``goes`` on ``mark`` and ``doc`` which windows go.
    """
    marks = written(minimisers(documents, unit, within), "minimisers")
    found = marks.groupBy("value").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.sum("n").alias("total")).filter(repeats)
    again = marks.select("uid", "value").join(found.select("value"), "value").distinct()
    places = occurrences(documents, unit, again).withColumn("digest", F.unhex(F.sha2("packed", 256)))
    places = written(places, "super-k-mers")
    strings = places.groupBy("value", "packed", "digest").agg(F.min("n").alias("n"), F.min("doc").alias("lo"), F.count("*").alias("times"))
    parts = written(judged(written(strings, "strings"), unit, judge, combine, alone, few, small), "judged")
    met = places.select("uid", "doc", "first", "digest").join(parts, "digest")
    gone = met.select("uid", "doc", "first", F.explode("parts").alias("part")).select(
        "uid", "doc", (F.col("first") + F.col("part.at")).alias("start"),
        (F.col("first") + F.col("part.at") + F.col("part.n") + (unit.size - 1)).alias("end"), F.col("part.mark").alias("mark"))
    gone = gone.filter(goes).select("uid", F.struct("start", "end").alias("span")).distinct()
    return gone.groupBy("uid").agg(F.sort_array(F.collect_list("span")).alias("spans"))


def union(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted spans without overlaps; spans that touch are one."""
    out: list[list[int]] = []
    for span in spans or ():
        if out and span["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span["end"])
        else:
            out.append([span["start"], span["end"]])
    return [tuple(s) for s in out]
