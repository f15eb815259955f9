"""Repeated lines, found with levelled sorted runs of line hashes. DataFrame functions only.

Documents arrive in batches of falling ``doc_id``. A batch is reduced to one row per line hash and document, and
merge-anti-joins the runs: a hash that no run has is new, and its largest document of the batch keeps its lines; every
other pair of hash and document is a repeat. The batch then adds its own new hashes as a sorted run of level 0;
``fan_in`` runs of a level are compacted into one run of the next level.

For scale: what travels is 16 bytes a line, not the line, and only of lines long enough to matter. Batches are cut at
approximate quantiles of ``doc_id``, their number is a parameter, and the runs of a hash are found by a join on it,
which spreads evenly; a line that every document holds is combined before it is shuffled. Texts are shuffled once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vecferry.llm.common import BLANK, LOWER, UPPER, sha256_hex, texts, written


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def line_hash(line: Column) -> Column:
    return F.unhex(F.md5(line_key(line).cast("binary")))


class Runs:
    """Sorted runs of hashes by level; ``add`` compacts a level that is full."""

    def __init__(self, fan_in: int) -> None:
        self.fan_in = fan_in
        self.levels: list[list[DataFrame]] = []

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, hashes: DataFrame, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        run = written(hashes.select("hash").repartition("hash").sortWithinPartitions("hash"), f"run{level}")
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_in:
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            self.add(merged, level + 1)


def line_pairs(documents: DataFrame, min_chars: int = 40) -> DataFrame:
    """One row per document and hash of its lines whose key has at least ``min_chars`` code points."""
    line = F.explode(F.split("text", "\n", -1)).alias("line")
    lines = texts(documents).select("doc_id", line).filter(F.length(F.btrim("line", F.lit(BLANK))) >= min_chars)
    return lines.select("doc_id", line_hash(F.col("line")).alias("hash")).distinct()


def repeated_pairs(pairs: DataFrame, min_documents: int = 5, batches: int = 3, fan_in: int = 2) -> DataFrame:
    """Pairs of document and hash whose lines go: the hash is in ``min_documents`` or more, and this isn't the largest."""
    ordered = pairs.withColumn("at", F.coalesce("doc_id", F.lit(-(1 << 63))))
    cuts = sorted(set(ordered.stat.approxQuantile("at", [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    number = reduce(lambda n, cut: n + (F.col("at") <= cut).cast("int"), cuts, F.lit(0))  # 0 has the largest ids
    dealt = ordered.withColumn("batch", number)
    runs, repeats = Runs(fan_in), []
    for b in range(len(cuts) + 1):
        batch = dealt.filter(F.col("batch") == b).select("doc_id", "at", "hash")
        holders = batch.groupBy("hash").agg(F.max("at").alias("first"))
        for run in runs.all():
            holders = holders.join(run.hint("merge"), "hash", "left_anti")
        new = written(holders, "new-lines")
        repeats.append(batch.join(new, "hash", "left").filter("first is null or at < first").select("doc_id", "hash"))
        runs.add(new)
    repeats = written(reduce(DataFrame.unionByName, repeats), "repeats")
    frequent = repeats.groupBy("hash").count().filter(F.col("count") >= min_documents - 1).select("hash")
    return repeats.join(frequent, "hash", "left_semi")


def line_dedup(documents: DataFrame, min_chars: int = 40, min_documents: int = 5, batches: int = 3, fan_in: int = 2) -> DataFrame:
    """A row per document: ``doc_id, text`` (the lines that stay, joined by a line feed), ``n_lines, n_dropped``.

    A text is split at line feeds; null or empty text is one empty line. Keys of at least ``min_chars`` code points
    that at least ``min_documents`` documents hold lose all their lines except in the largest ``doc_id`` that holds them
    (null is the smallest). Rows that repeat a ``doc_id`` are one document: its lines are those of all its rows.
    """
    pairs = written(line_pairs(documents, min_chars), "line-pairs")
    gone = repeated_pairs(pairs, min_documents, batches, fan_in)
    gone = gone.groupBy("doc_id").agg(F.collect_list("hash").alias("gone")).withColumnRenamed("doc_id", "_of")
    met = texts(documents).join(gone, F.col("doc_id").eqNullSafe(F.col("_of")), "left")
    lines = F.split("text", "\n", -1)
    stay = F.when(F.col("gone").isNull(), lines).otherwise(F.filter(
        lines, lambda l: ~((F.length(F.btrim(l, F.lit(BLANK))) >= min_chars) & F.array_contains("gone", line_hash(l)))))
    out = met.select("doc_id", "text", F.size(lines).cast("long").alias("n_lines"), stay.alias("stay"))
    return out.select(
        "doc_id", F.array_join("stay", "\n").alias("text"), "n_lines", (F.col("n_lines") - F.size("stay")).alias("n_dropped"))


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("text")).alias("kept_sha256"))
