"""Quality rules: fixed counts, and a calibrated logistic regression on hashed word and character n-grams.

Features are the relative frequencies of word 1-grams and 2-grams and of character 3-grams and 4-grams, hashed into
``2 ** BITS`` places, words and characters apart. The model is fitted on a bounded sample of the labelled rows: at most
``train_rows`` of them, those with the lowest hash of ``doc_id``. Three quarters train, in a few tasks whose weights are
averaged; the last quarter calibrates the score to a probability (Platt's two parameters). Documents are scored in Arrow
batches against fixed thresholds, one pass without a shuffle.

For scale: the model is a vector of fixed length, which travels with the task; the sample is bounded by a parameter, its
texts are read by one scan and stay on the executors. Nothing else depends on the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vecferry.llm.common import returning, texts, unused, written

BITS = 16
PLACES = 1 << BITS
SCALE = 20.0
SLAB_CHARS = 1 << 20
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)

MIN_WORDS, MAX_REPEAT_PERCENT, MIN_PROBABILITY = 10, 20, 0.5


@dataclass(frozen=True)
class Model:
    """Weights by hashed n-gram (words, then characters), and the two parameters of the calibration."""

    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * scores + self.offset, -40, 40)))


def word_places(crcs: np.ndarray) -> np.ndarray:
    """Hashed 1-grams and 2-grams of one run of words, given by their checksums."""
    c = crcs.astype(np.uint32)
    one = (c * np.uint32(MIX[0])) >> np.uint32(32 - BITS)
    two = (c[:-1] * np.uint32(MIX[1]) + c[1:] * np.uint32(MIX[2])) * np.uint32(MIX[3]) >> np.uint32(32 - BITS)
    return np.concatenate([one, two]).astype(np.int64)


def char_places(text: str) -> np.ndarray:
    """Hashed 3-grams and 4-grams of code points."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    three = c[:-2] * np.uint32(MIX[0]) + c[1:-1] * np.uint32(MIX[1]) + c[2:] * np.uint32(MIX[2]) if len(c) > 2 else c[:0]
    four = three[:-1] * np.uint32(MIX[3]) + c[3:] * np.uint32(MIX[0])
    mixed = np.concatenate([three[:SLAB_CHARS], four[:SLAB_CHARS]])
    return ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(MIX[1]) >> np.uint32(32 - BITS)).astype(np.int64) + PLACES


def _slabs(text: str) -> Iterator[str]:
    """Parts of a very long text, with the three code points behind, so that each n-gram is whole where it starts."""
    for at in range(0, max(1, len(text)), SLAB_CHARS):
        yield text[at : at + SLAB_CHARS + 3]


def score(text: str, crcs: np.ndarray, weights: np.ndarray) -> float:
    total = 0.0
    if len(crcs):
        places = word_places(crcs)
        total += weights[places].sum() / len(places)
    sums = count = 0.0
    for part in _slabs(text):
        places = char_places(part)
        sums += weights[places].sum()
        count += len(places)
    return SCALE * (total + (sums / count if count else 0.0))


def _words(body: bytes) -> tuple[list[bytes], np.ndarray]:
    words = body.split()
    return words, np.fromiter(map(crc32, words), np.uint32, len(words))


def repeated_words(words: list[bytes], crcs: np.ndarray, size: int = 5) -> int:
    """How many words lie in windows of ``size`` words that occur at least twice in the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, np.uint64)
    for j in range(size):
        mixed = (mixed ^ crcs[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0  # equal windows have equal hashes
    maybe = np.zeros(n, bool)
    maybe[order[1:][same]] = maybe[order[:-1][same]] = True
    found: dict = {}
    at = np.flatnonzero(maybe).tolist()
    for i in at:
        found.setdefault(tuple(words[i : i + size]), []).append(i)
    covered = np.zeros(len(words) + 1, np.int64)
    for places in found.values():
        if len(places) > 1:
            covered[places] += 1
            covered[np.array(places) + size] -= 1
    return int((np.cumsum(covered)[:-1] > 0).sum())


def measure(body: bytes, text: str, words: list[bytes], crcs: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(text) - sum(body.count(b) for b in BLANKS)
    symbols = sum(body.count(b) for b in SYMBOLS)
    lines = [line for line in body.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words, crcs)


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, probability double")
VERDICT_TYPE = f"struct<{VERDICT}>"


def _train(batches: Iterator[pa.RecordBatch], rounds: int, rate: float, ridge: float) -> np.ndarray | None:
    """Weights of one task: logistic regression by full gradients with Adam."""
    places, values, owners, labels = [], [], [], []
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            _, crcs = _words(text.encode("utf-8", "surrogatepass"))
            halves = [word_places(crcs) if len(crcs) else np.zeros(0, np.int64), np.concatenate([char_places(p) for p in _slabs(text)])]
            for half in halves:
                if len(half):
                    place, n = np.unique(half, return_counts=True)
                    places.append(place)
                    values.append(SCALE * n / len(half))
                    owners.append(np.full(len(place), len(labels)))
            labels.append(label)
    if not places:
        return None
    at, x, of, y = np.concatenate(places), np.concatenate(values), np.concatenate(owners), np.array(labels, float)
    w, m, v = np.zeros(2 * PLACES), np.zeros(2 * PLACES), np.zeros(2 * PLACES)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))  # both classes count alike
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of, x * w[at], len(y)), -40, 40)))
        g = np.bincount(at, x * ((p - y) * weight)[of], 2 * PLACES) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit(
    documents: DataFrame, labels: DataFrame, train_rows: int = 3000, tasks: int = 4, rounds: int = 60, rate: float = 0.05,
    ridge: float = 1e-4,
) -> Model:
    """Fits on at most ``train_rows`` rows of ``labels`` (doc_id, quality); rows without a label or a text are left out.

    Without rows of both classes there is nothing to learn: every probability is then that of the rules alone, 1.
    """
    picked = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("label"))
    picked = picked.filter("_id is not null and label in (0, 1)").dropDuplicates(["_id"])
    picked = picked.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)  # a bounded sample, see above
    sample = texts(documents).join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    turn = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4))
    sample = written(sample.select("doc_id", "text", "label", turn.alias("fold")), "labelled")
    classes = {r[0] for r in sample.filter("fold > 0").select("label").distinct().collect()}
    if len(classes) < 2:
        return Model(np.zeros(2 * PLACES), 0.0, 40.0)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _train(batches, rounds, rate, ridge)
        if w is not None:
            yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()], pa.binary())], names=["w"])

    part = F.pmod(F.xxhash64("doc_id", F.lit("task")), F.lit(tasks)).cast("int")
    parts = sample.filter("fold > 0").repartition(tasks, part).sortWithinPartitions("doc_id", "text")
    fitted = sorted(bytes(r[0]) for r in parts.mapInArrow(returning(train), "w binary").collect())  # one vector of fixed length a task
    weights = np.mean([np.frombuffer(w, np.float32) for w in fitted], axis=0)

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [score(t, _words(t.encode("utf-8", "surrogatepass"))[1], weights) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.float64()), batch.column("label")], names=["score", "label"])

    rows = sample.filter("fold = 0").select("text", "label").mapInArrow(returning(held_out), "score double, label int").collect()  # a quarter of the sample
    slope, offset = _platt(sorted((r[0], r[1]) for r in rows))
    return Model(weights, slope, offset)


def _platt(rows: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities, by Newton steps on smoothed targets."""
    if len({label for _, label in rows}) < 2:
        return 1.0, 0.0
    s, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * s + b, -40, 40)))
        d, h = p - target, p * (1 - p) + 1e-9
        g = np.array([(d * s).sum() + 1e-3 * (a - 1), d.sum()])
        hess = np.array([[(h * s * s).sum() + 1e-3, (h * s).sum()], [(h * s).sum(), h.sum()]])
        step = np.linalg.solve(hess + 1e-9 * np.eye(2), g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def verdict(text: Column, model: Model, min_probability: float = MIN_PROBABILITY) -> Column:
    """A struct column of ``VERDICT`` for each text, null counting as empty."""

    def judge(column: pa.Array) -> pa.Array:
        rows = []
        for text, body in zip(column.to_pylist(), column.cast(pa.binary()).to_pylist(), strict=True):
            text, body = text or "", body or b""
            words, crcs = _words(body)
            counts = measure(body, text, words, crcs)
            failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
            p = float(model.probability(np.array([score(text, crcs, model.weights)]))[0])
            rows.append((*counts, failed, not failed and p >= min_probability, p))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    @F.arrow_udf(VERDICT_TYPE)
    def judged(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return returning(lambda parts: map(judge, parts))(columns)

    return judged.asNondeterministic()(text)  # so that it runs once, also where a filter reads it


def quality_rules(documents: DataFrame, model: Model) -> DataFrame:
    """A row per document: ``doc_id`` and the columns of ``VERDICT``.

    ``base_failed`` is true below ``MIN_WORDS`` words or when more than ``MAX_REPEAT_PERCENT`` percent of the words lie
    in repeated windows; ``kept`` is false then, and otherwise says if the probability reaches ``MIN_PROBABILITY``. Null
    and empty texts have counts of 0 and fail. Repeated rows are judged alike. An empty table gives no rows.
    """
    judged = texts(documents).select("doc_id", verdict(F.col("text"), model).alias("v"))
    return judged.select("doc_id", "v.*")


def keep_quality(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that the rules keep, all their columns."""
    name = unused("_verdict", documents.columns)
    judged = documents.withColumn(name, verdict(F.coalesce("text", F.lit("")), model))
    return judged.filter(F.col(name)["kept"]).drop(name)
