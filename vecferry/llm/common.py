"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from vecferry.session import work_path

BLANK = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def texts(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), nothing else."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def sliced(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut into pieces of at most so many bytes of ``text``, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        low = 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(low, high - low)
            low = high


def give_back(encoders: bool = False) -> None:
    """Returns what this Python process no longer holds to the system; unless ``encoders``, its stored encoders go too.

    Spark keeps Python workers for later tasks. What their allocators hold back would lie beside the executor's heap all
    the while, also in steps that run no Python.
    """
    if not encoders and "tokenizers" in sys.modules:
        vars(sys.modules["tokenizers"]).pop("_vecferry_encoders", None)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def returning(run: Callable[[Iterator], Iterator], encoders: bool = False) -> Callable[[Iterator], Iterator]:
    """``run``, a function of a task's batches, with ``give_back`` at the end of the task."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back(encoders)

    return whole


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def unused(name: str, taken: list[str]) -> str:
    """A column name that clashes with none of those taken."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def keep(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose ``doc_id`` is among ``ids``, all their columns; a null matches a null."""
    name = unused("_stays", documents.columns)
    stay = ids.select(F.col("doc_id").alias(name))
    return documents.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi")


def written(table: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder, compressed: cuts lineage, and several steps may read it."""
    path = work_path(table.sparkSession, name)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
