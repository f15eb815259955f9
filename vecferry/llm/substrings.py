"""Removes passages that an earlier document has: windows of consecutive words, by super-k-mer partitioning.

Windows that share a minimiser travel as one packed string to the bucket of the minimiser, where sorting brings equal
windows together and tells the smallest ``doc_id`` that each starts in. See ``windows`` for what travels and why.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vecferry.llm import windows
from vecferry.llm.common import sha256_hex


def _first_documents(unit: windows.Words) -> windows.Judge:
    def judge(strings: list[tuple[bytes, int, int]]) -> list[list[tuple[int, int, int]]]:
        marks = [[0] * 0 for _ in strings]
        rows = []
        for s, (packed, lo, _) in enumerate(strings):
            cut = unit.cut(packed)
            marks[s] = [lo] * len(cut)
            rows += [(w, lo, s, i) for i, w in enumerate(cut)]
        rows.sort()  # equal windows together, the smallest document first
        at = least = None
        for w, lo, s, i in rows:
            if w != at:
                at, least = w, lo
            marks[s][i] = least
        return [windows.as_runs(m) for m in marks]

    return judge


def passage_dedup(documents: DataFrame, size: int = 50, gram: int = 8, few: int = windows.FEW, small: int = windows.SMALL) -> DataFrame:
    """A row per document: ``doc_id, text`` (the words that stay, joined by a space), ``n_words, n_removed``.

    A word goes when a window of ``size`` words that covers it also starts in a document with a smaller ``doc_id``;
    windows are judged on the input. Null and empty texts have no words. A null ``doc_id`` is larger than all others,
    and documents with the same ``doc_id`` take nothing from each other. An empty table gives no rows.
    """
    unit = windows.Words(size, gram)
    rows = windows.keyed(documents)
    spans = windows.covered(
        rows, unit, _first_documents(unit), within=False, repeats="lo < hi", combine="min(lo)", alone="true", goes="mark < doc", few=few, small=small)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, total, removed = [], [], []
            for body, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = body.split()
                stay, at = [], 0
                for start, end in windows.union(found):
                    stay += words[at:start]
                    at = end
                stay += words[at:]
                kept.append(b" ".join(stay))
                total.append(len(words))
                removed.append(len(words) - len(stay))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                names=["doc_id", "text", "n_words", "n_removed"])

    met = rows.join(spans.withColumnRenamed("uid", "_uid"), F.col("uid") == F.col("_uid"), "left")
    return met.select("doc_id", "text", "spans").mapInArrow(clean, "doc_id long, text string, n_words long, n_removed long")


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", sha256_hex(F.col("text")).alias("kept_sha256"))
