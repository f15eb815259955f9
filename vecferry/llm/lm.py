"""Prediction by partial matching over bytes: a trie of byte contexts that all training documents fill.

A text is lower-cased (A-Z) and read as its words, one blank between two, and an end symbol. The trie has a node for every
context of up to ``order`` bytes (before the text stand end symbols) and every byte seen after it, with the count. A byte
is predicted in its longest context: a byte seen there has count / (total + distinct), the rest, distinct / (total +
distinct), is the escape to the context that is one byte shorter. What the longer context had seen cannot come any more and
is left out there, of counts, total and distinct alike (symbol exclusion). Below the empty context all bytes left are
equally likely. A document's code length is the sum over its bytes.

The probability of a byte depends on itself and the ``order`` bytes before it alone. So the trie is computed level by level
with joins, ends in a table of every (order + 1)-gram of the corpus with its probability, and a text is scored by looking
its grams up. Nothing of the trie is left out, and its levels grow with the corpus.

For scale: grams and words are counted in the tasks and combined before they are shuffled. The most frequent grams and
words, a bounded number, are broadcast; all others meet their documents in a shuffle join, whose keys are rare by
construction. Levels of short contexts are small by their nature: 256 contexts of one byte.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vecferry.llm.common import sliced, texts, written

ORDER = 5
FOLDS = 10
END = b"\n"  # no word holds it
ALPHABET = 256
HOT_GRAMS = 1 << 20  # broadcast, 12 to 24 bytes each
HOT_WORDS = 1 << 18
SLAB = 1 << 20  # bytes of text that are looked up at once
SLICE = 1 << 19  # bytes of text whose words are held at once, or one text: as objects they take ten times that
HELD_GRAMS = 1 << 21  # distinct grams that a task holds before it passes them on
HELD_WORDS = 1 << 19
HELD_BYTES = 1 << 27  # of text that words are counted over
SMALL_LEVEL = 1 << 16  # contexts or nodes of a level that is broadcast: those of up to two bytes

COUNTS = "word binary, code long, held_out boolean, n long"


def labelled(documents: DataFrame) -> DataFrame:
    """``doc_id, text, held_out``: a tenth of the documents, by the crc32 of the ``doc_id``, is not learned from."""
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    return texts(documents).select("doc_id", "text", held.alias("held_out"))


class Sequence:
    """The bytes of several texts, one after another, each after ``order`` end symbols."""

    def __init__(self, order: int, split: list[list[bytes]]) -> None:
        self.order = order
        bodies = [b" ".join(words) for words in split]
        lengths = np.fromiter(map(len, bodies), np.int64, len(bodies)) + 1
        gap = END * order
        self.bytes = np.frombuffer(gap + gap.join(bodies) + gap, np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(lengths + order - 1)])[: len(bodies)]  # counted without the first gap
        self.size = len(self.bytes) - order if bodies else 0
        self.filler = (self.bytes[order:] == END[0]) & (self.bytes[order - 1 : -1] == END[0]) if order else np.zeros(self.size, bool)
        self.filler[self.starts[lengths == 1]] = False  # the end of an empty text

    def codes(self, low: int, high: int) -> np.ndarray:
        """The grams that end at the places from ``low`` to ``high``, as integers."""
        codes = np.zeros(high - low, np.int64)
        for j in range(self.order + 1):
            codes <<= 8
            codes |= self.bytes[low + j : high + j]
        return codes

    def slabs(self) -> Iterator[tuple[int, int]]:
        return ((low, min(low + SLAB, self.size)) for low in range(0, self.size, SLAB))


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.argsort(codes, kind="stable")
    codes, n = codes[at], n[at]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(n, first)


class _Grams:
    """Counts of grams; ``full`` when as many as a task may hold are distinct."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, codes: np.ndarray) -> None:
        if not len(codes):
            return
        codes = np.sort(codes)
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        self.parts.append((codes[first], np.diff(np.append(first, len(codes)))))
        self.held += len(first)
        if self.held > HELD_GRAMS:
            self.combine()

    def combine(self) -> None:
        if len(self.parts) > 1:
            self.parts = [_summed(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))]
            self.held = len(self.parts[0][0])

    @property
    def full(self) -> bool:
        return self.held > HELD_GRAMS // 2 and len(self.parts) == 1

    def table(self, held_out: bool) -> pa.RecordBatch:
        self.combine()
        codes, n = self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.clear()
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(codes), pa.binary()), pa.array(codes), pa.array([held_out] * len(codes), pa.bool_()), pa.array(n, pa.int64())],
            names=["word", "code", "held_out", "n"])


def _words_table(words: Counter, held_out: bool) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays(
        [pa.array(list(words), pa.binary()), pa.nulls(len(words), pa.int64()), pa.array([held_out] * len(words), pa.bool_()),
         pa.array(list(words.values()), pa.int64())], names=["word", "code", "held_out", "n"])
    words.clear()
    return out


def counts(marked: DataFrame, order: int) -> DataFrame:
    """Rows ``word, code, held_out, n`` of what the tasks have counted: words (the end is one) and grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words, grown = (_Grams(), _Grams()), (Counter(), Counter()), 0
        for batch in sliced(batches, SLICE):
            flags = batch.column("held_out").to_pylist()
            bodies = batch.column("text").cast(pa.binary()).to_pylist()
            grown += sum(map(len, bodies))
            for side in (0, 1):
                split = [body.lower().split() for body, held in zip(bodies, flags, strict=True) if held == side]
                for found in split:
                    words[side].update(found)
                if split:
                    words[side][END] += len(split)
                sequence = Sequence(order, split)
                for low, high in sequence.slabs():
                    grams[side].add(sequence.codes(low, high)[~sequence.filler[low:high]])
                    if grams[side].full:
                        yield grams[side].table(bool(side))
            if max(map(len, words)) > HELD_WORDS or grown > HELD_BYTES:
                for side in (0, 1):
                    yield _words_table(words[side], bool(side))
                grown = 0
        for side in (0, 1):
            yield grams[side].table(bool(side))
            yield _words_table(words[side], bool(side))

    return marked.select("text", "held_out").mapInArrow(run, COUNTS)


def _totals(found: DataFrame, key: str) -> DataFrame:
    return found.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(F.when(F.col("held_out"), F.lit(0)).otherwise(F.col("n"))).alias("c"), F.sum("n").alias("n_all"))


def _level(nodes: DataFrame) -> DataFrame:
    """Total and distinct symbols of each context beside its nodes; a context has 256 at most."""
    context = Window.partitionBy("context")
    return nodes.withColumns({"total": F.sum("c").over(context), "distinct": F.count("*").over(context)})


def trie(grams: DataFrame, order: int) -> list[DataFrame]:
    """Nodes ``context, symbol, c, total, distinct`` by length of the context, 0 to ``order``; each level written once."""
    nodes = grams.filter("c > 0").select(F.shiftright("code", 8).alias("context"), F.col("code").bitwiseAND(255).alias("symbol"), "c")
    levels = [written(_level(nodes), f"level{order}")]
    for length in range(order - 1, -1, -1):
        shorter = F.col("context").bitwiseAND((1 << 8 * length) - 1).alias("context")
        nodes = levels[-1].select(shorter, "symbol", "c").groupBy("context", "symbol").agg(F.sum("c").alias("c"))
        levels.append(written(_level(nodes), f"level{length}"))
    return levels[::-1]


def _small(table: DataFrame, length: int) -> DataFrame:
    """Broadcast where the length alone bounds the rows."""
    return F.broadcast(table) if ALPHABET ** length <= SMALL_LEVEL else table


def contexts(levels: list[DataFrame], length: int) -> DataFrame:
    """``context, total, distinct`` and ``gone``: what the symbols seen here count in the context that is a byte shorter."""
    here = levels[length]
    if not length:
        return here.groupBy("context").agg(F.first("total").alias("total"), F.first("distinct").alias("distinct"), F.lit(0).cast("long").alias("gone"))
    below = levels[length - 1].select(F.col("context").alias("shorter"), F.col("symbol").alias("of"), F.col("c").alias("less"))
    met = here.withColumn("shorter", F.col("context").bitwiseAND((1 << 8 * (length - 1)) - 1))
    met = met.join(_small(below, length), on=[met["shorter"] == below["shorter"], met["symbol"] == below["of"]])
    return met.groupBy("context").agg(F.first("total").alias("total"), F.first("distinct").alias("distinct"), F.sum("less").alias("gone"))


def model(grams: DataFrame, order: int) -> DataFrame:
    """``code, n_all, log10p`` of every gram of the corpus, also of those that only held-out documents have."""
    levels = trie(grams, order)
    top = levels[order]
    seen = top.select(
        F.shiftleft("context", 8).bitwiseOR(F.col("symbol")).alias("code"), F.log10(F.col("c") / (F.col("total") + F.col("distinct"))).alias("log10p"))
    seen = grams.filter("c > 0").select("code", "n_all").join(seen, "code")
    rest = grams.filter("c = 0").select(
        "code", "n_all", F.col("code").bitwiseAND(255).alias("symbol"), F.lit(0.0).alias("so_far"), F.lit(None).cast("double").alias("log10p"),
        F.lit(0).cast("long").alias("gone"), F.lit(0).cast("long").alias("ruled_out"))
    for length in range(order, -1, -1):
        here = contexts(levels, length).select(
            F.col("context").alias("_context"), F.col("total").alias("_total"), F.col("distinct").alias("_distinct"), F.col("gone").alias("_gone"))
        node = levels[length].select(F.col("context").alias("_of"), F.col("symbol").alias("_symbol"), F.col("c").alias("_c"))
        rest = rest.withColumn("context", F.shiftright("code", 8).bitwiseAND((1 << 8 * length) - 1))
        rest = rest.join(_small(here, length), F.col("context") == F.col("_context"), "left")
        rest = rest.join(_small(node, length + 1), (F.col("context") == F.col("_of")) & (F.col("symbol") == F.col("_symbol")), "left")
        total, distinct = F.col("_total") - F.col("gone"), F.col("_distinct") - F.col("ruled_out")
        found = F.col("log10p").isNull() & F.col("_c").isNotNull()
        escape = F.when(distinct > 0, F.log10(distinct / (total + distinct))).otherwise(0.0)
        rest = rest.select(
            "code", "n_all", "symbol",
            (F.col("so_far") + F.when(F.col("_total").isNotNull(), escape).otherwise(0.0)).alias("so_far"),
            F.when(found, F.col("so_far") + F.log10(F.col("_c") / (total + distinct))).otherwise(F.col("log10p")).alias("log10p"),
            F.coalesce("_gone", F.lit(0)).alias("gone"), F.coalesce("_distinct", F.lit(0)).alias("ruled_out"))
        rest = written(rest, f"escaped{length}")
    rest = rest.select("code", "n_all", F.coalesce("log10p", F.col("so_far") - F.log10(ALPHABET - F.col("ruled_out"))).alias("log10p"))
    return seen.select("code", "n_all", "log10p").unionByName(rest)


def _frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows with the largest ``n_all``, at most ``most``: as many steps of a logarithmic scale as fit."""
    step = F.floor(F.log2("n_all") * 16).alias("step")
    steps = sorted(((r.step, r.n) for r in table.groupBy(step).agg(F.count("*").alias("n")).collect()), reverse=True)  # 1024 at most
    held, least = 0, None
    for at, n in steps:
        if held + n > most:
            break
        held, least = held + n, at
    return table.filter(F.lit(False)) if least is None else table.filter(F.floor(F.log2("n_all") * 16) >= least)


class Lookup:
    """Values of integer keys in hashed slots, three tables one behind another; a miss means: not here.

    A table has two to four slots for each key that the tables before it have not taken.
    """

    MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Of keys that want the same slot the first gets it."""
        self.tables = []
        for number in range(len(self.MULTIPLIERS)):
            bits = max(4, int(np.ceil(np.log2(max(1, len(keys))))) + 1)
            slot = self._slot(keys, number, bits)
            taken, first = np.unique(slot, return_index=True)
            held = np.full(1 << bits, -1, np.int64)
            of = np.zeros(1 << bits, np.float64)
            held[taken], of[taken] = keys[first], values[first]
            self.tables.append((bits, held, of))
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, values = keys[left], values[left]

    def _slot(self, keys: np.ndarray, number: int, bits: int) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(self.MULTIPLIERS[number]) >> np.uint64(64 - bits)).view(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, 0 where missing; places of the missing keys)."""
        out = np.zeros(len(keys))
        places = None
        for number, (bits, held, of) in enumerate(self.tables):
            slot = self._slot(keys, number, bits)
            hit = held[slot] == keys
            if places is None:
                out = np.where(hit, of[slot], 0.0)
                places = np.flatnonzero(~hit)
            else:
                out[places[hit]] = of[slot[hit]]
                places = places[~hit]
            if not len(places):
                break
            keys = keys[~hit]
        return out, places


SCORED = (
    "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, "
    "rare_words array<binary>, rare_grams array<long>")


def _lists(values: pa.Array, owners: np.ndarray, n: int) -> pa.ListArray:
    """``values`` as n lists; ``owners`` are their lists' numbers, ascending."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owners, np.arange(n + 1)), pa.int32()), values)


def _scored(marked: DataFrame, hot, order: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lookup = hot.value
        uid = TaskContext.get().partitionId() << 40
        for batch in sliced(batches, SLICE):
            n = batch.num_rows
            split = [body.as_py().lower().split() for body in batch.column("text").cast(pa.binary())]
            logs, n_known = np.zeros(n), np.zeros(n, np.int64)
            words, word_owners = [], []
            for i, found in enumerate(split):
                found = found + [END]
                c = np.fromiter(map(known.get, found, repeat(-1)), np.int64, len(found))
                here = c[c >= 0]
                logs[i], n_known[i] = np.log10(here + 0.1).sum(), np.count_nonzero(here)
                if len(here) < len(found):
                    rare = np.flatnonzero(c < 0).tolist()
                    words.extend([found[at] for at in rare])
                    word_owners.extend([i] * len(rare))
            sequence, score = Sequence(order, split), np.zeros(n)
            grams, gram_owners = [], []
            for low, high in sequence.slabs():
                codes = sequence.codes(low, high)
                filler = sequence.filler[low:high]
                values, missing = lookup.get(codes)
                values[filler] = 0.0
                owner = int(np.searchsorted(sequence.starts, low, "right")) - 1
                last = int(np.searchsorted(sequence.starts, high - 1, "right")) - 1
                cuts = np.concatenate([[0], sequence.starts[owner + 1 : last + 1] - low])
                score[owner : last + 1] += np.add.reduceat(values, cuts)
                missing = missing[~filler[missing]]
                grams.append(codes[missing])
                gram_owners.append(np.searchsorted(sequence.starts, missing + low, "right") - 1)
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(uid + np.arange(n)), batch.column("doc_id"), batch.column("held_out"),
                pa.array([len(found) + 1 for found in split], pa.int64()), pa.array(n_known), pa.array(logs), pa.array(score),
                _lists(pa.array(words, pa.binary()), np.array(word_owners, np.int64), n),
                _lists(pa.array(np.concatenate([none, *grams])), np.concatenate([none, *gram_owners]), n),
            ], names=[c.split()[0] for c in SCORED.split(", ")])
            uid += n

    return marked.mapInArrow(run, SCORED)


def _broadcast(spark: SparkSession, words: DataFrame, grams: DataFrame, hot_words: int, hot_grams: int):
    """The frequent words with their counts, and the frequent grams with their probabilities; both bounded in number."""
    common = _frequent(words.filter(F.length("word") <= 64), hot_words).select("word", "c").toArrow()
    known = dict(zip(common.column("word").to_pylist(), common.column("c").to_pylist(), strict=True))
    frequent = _frequent(grams, hot_grams).select("code", "log10p", "n_all").toArrow()
    at = np.argsort(-frequent.column("n_all").to_numpy(), kind="stable")
    return spark.sparkContext.broadcast((known, Lookup(frequent.column("code").to_numpy()[at], frequent.column("log10p").to_numpy()[at])))


def score_texts(documents: DataFrame, order: int = ORDER, hot_words: int = HOT_WORDS, hot_grams: int = HOT_GRAMS) -> DataFrame:
    """A row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``score`` is the log10 probability that the contexts give the text, ``base_score`` that of its tokens one by one with
    0.1 added to every count; tokens are the words and one end. Both learn from all documents that aren't held out.
    A null text is empty: the end alone. A null ``doc_id`` counts as the empty name, which is held out. Very long texts
    are read whole, a slab at a time; their words are held as a list while one is scored. Repeated rows each count
    and each return. With nothing to learn from all bytes are equally likely. An empty table gives no rows.
    """
    if not 0 < order < 7:
        raise ValueError("a gram fits 56 bits: order 1 to 6")
    marked = labelled(documents)
    found = written(counts(marked, order), "counted")
    words = written(_totals(found, "word"), "words")
    grams = written(_totals(found, "code"), "grams")
    known = words.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    probabilities = written(model(grams, order), "probabilities")
    hot = _broadcast(documents.sparkSession, words, probabilities, hot_words, hot_grams)
    scored = written(_scored(marked, hot, order), "scored")
    own = ["doc_id", "held_out", "n_tokens"]
    sums = {"n_known": "long", "logs": "double", "score": "double"}
    zero = lambda names: [F.lit(0).cast(sums[c]).alias(c) for c in names]
    nothing = [F.lit(None).cast(scored.schema[c].dataType).alias(c) for c in own]
    rare = scored.select("uid", F.explode("rare_words").alias("word")).join(words.select("word", "c"), "word")
    rare = rare.select("uid", *nothing, (F.col("c") > 0).cast("long").alias("n_known"), F.log10(F.col("c") + 0.1).alias("logs"), *zero(["score"]))
    escaped = scored.select("uid", F.explode("rare_grams").alias("code")).join(probabilities.select("code", "log10p"), "code")
    escaped = escaped.select("uid", *nothing, *zero(["n_known", "logs"]), F.col("log10p").alias("score"))
    parts = scored.select("uid", *own, *sums).unionByName(rare).unionByName(escaped)
    whole = parts.groupBy("uid").agg(*[F.max(c).alias(c) for c in own], *[F.sum(c).alias(c) for c in sums])
    every = float(np.log10(known.n + 0.1 * (known.v + 1)))
    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(known.n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * every).alias("base_score"), "score")
