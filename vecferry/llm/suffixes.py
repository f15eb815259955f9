"""Removes byte strings that occur twice, with suffix arrays built by the difference-cover algorithm.

Suffixes at places 1 and 2 modulo 3 are sorted by their first three symbols and named by rank; while names repeat, the
algorithm recurses on the string of names. The other suffixes are sorted by one symbol and the rank behind it, both
orders are merged, and a string occurs twice when neighbours in the order share a prefix of its length.

A suffix array over every byte of the corpus, with a row per suffix, would shuffle some 15 times the input at each of a
dozen levels. Equal strings have equal minimisers, so the strings are first dealt out by minimiser (see ``windows``), and
each task sorts the suffixes of the groups it owns, which no match leaves. What is whole in several places is combined
and needs no sorting against itself; groups too large for memory go through digests of single strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vecferry.llm import windows


MOST_SYMBOLS = 2_000_000


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The order of the suffixes of ``s``, numbers from 1 on, by difference cover modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s, [0, 0, 0]]).astype(np.int64)
    extra = n % 3 == 1  # a triple of zeros then ends the places 1 modulo 3
    sample = np.concatenate([np.arange(1, n + extra, 3), np.arange(2, n, 3)])
    size = int(t.max()) + 1
    if size > MOST_SYMBOLS:
        raise ValueError(f"more than {MOST_SYMBOLS} symbols")  # a triple must fit into one number
    triple = (t[sample] * size + t[sample + 1]) * size + t[sample + 2]
    order = np.argsort(triple)
    by, triple = sample[order], triple[order]
    new = np.concatenate([[True], triple[1:] != triple[:-1]])
    names = np.empty(len(sample), np.int64)
    names[order] = np.cumsum(new)
    if new.all():
        sampled = by
    else:
        sampled = sample[suffix_array(names)]
    rank = np.zeros(n + 3, np.int64)
    rank[sampled] = np.arange(1, len(sampled) + 1)
    sampled = sampled[sampled < n]
    others = np.arange(0, n, 3)
    wide = np.int64(len(sampled) + 2)
    single = t[others] * wide + rank[others + 1]
    order = np.argsort(single)
    others, single = others[order], single[order]
    # Merge: how many sampled suffixes of either kind come before each other one.
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(t[ones] * wide + rank[ones + 1], single)
    before = before + np.searchsorted((t[twos] * size + t[twos + 1]) * wide + rank[twos + 2], (t[others] * size + t[others + 1]) * wide + rank[others + 2])
    out = np.empty(n, np.int64)
    place = np.arange(len(others)) + before
    out[place] = others
    rest = np.ones(n, bool)
    rest[place] = False
    out[rest] = sampled
    return out


def repeated_places(strings: list[bytes], size: int) -> np.ndarray:
    """For each place of all strings, one after another with a mark after each, if ``size`` bytes from it occur twice."""
    lengths = np.array([len(x) for x in strings])
    ends = np.cumsum(lengths + 1) - 1
    symbols = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + len(strings) + 1
    symbols[ends] = np.arange(1, len(strings) + 1)  # a mark of its own ends each string
    order = suffix_array(symbols)
    room = np.repeat(ends, lengths + 1) - np.arange(len(symbols))
    first, second = order[:-1], order[1:]
    same = (room[first] >= size) & (room[second] >= size)
    words = windows.eights(b"\0".join(strings) + b"\0" * 9)
    for at in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
        first, second = first[same], second[same]
        same = words[first + at] == words[second + at]
    out = np.zeros(len(symbols), bool)
    out[first[same]] = out[second[same]] = True
    return out


def _twice(unit: windows.Bytes) -> windows.Judge:
    def judge(strings: list[tuple[bytes, int, int]]) -> list[list[tuple[int, int, int]]]:
        found = repeated_places([p for p, _, _ in strings], unit.size)
        out, at = [], 0
        for packed, _, times in strings:
            n = len(packed) - unit.size + 1
            out.append([(0, n, 2)] if times > 1 else windows.as_runs((found[at : at + n] + 1).tolist()))
            at += len(packed) + 1
        return out

    return judge


def byte_dedup(documents: DataFrame, size: int = 200, gram: int = 32, few: int = windows.FEW, small: int = 1 << 20) -> DataFrame:
    """A row per document: ``doc_id, kept`` (the bytes that stay), ``n_bytes, n_removed, n_spans``.

    A byte goes when a string of ``size`` bytes that covers it starts anywhere else too, in this document or another;
    strings are judged on the input and never cross documents. Null and empty texts have no bytes. Rows that are listed
    twice repeat each other. An empty table gives no rows.
    """
    unit = windows.Bytes(size, gram)
    rows = windows.keyed(documents)
    spans = windows.covered(
        rows, unit, _twice(unit), within=True, repeats="total > 1", combine="sum(times)", alone="times > 1", goes="mark > 1", few=few, small=small)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, total, removed, n_spans = [], [], [], []
            for body, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                gone = windows.union(found)
                edges = [0, *(e for span in gone for e in span), len(body)]
                kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                total.append(len(body))
                removed.append(len(body) - len(kept[-1]))
                n_spans.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (total, removed, n_spans))],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    met = rows.join(spans.withColumnRenamed("uid", "_uid"), F.col("uid") == F.col("_uid"), "left")
    return met.select("doc_id", "text", "spans").mapInArrow(clean, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
