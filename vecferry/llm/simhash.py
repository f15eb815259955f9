"""Near duplicates by SimHash, found with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. Two fingerprints that differ in at most 2 bits agree in
at least one segment (pigeonhole), and every other segment differs in at most 2 bits. The perfect Golay code of 23 bits
decodes each word to the one codeword within 3 bits; the codewords to which the words within 1 bit of a segment decode
are its keys, six at most, and two segments within 2 bits share at least one key, that of a word between them. So
(an exact segment, a key of the next one) for each of the three segments, 18 keys at most, finds every link. The
distance is then checked, so nothing else is linked.

For scale: equal fingerprints are one node. A key that up to ``few`` fingerprints share gives its pairs. Fingerprints of
larger groups are not paired: two words are within 2 bits exactly when some word is within 1 bit of both, so linking
each to the smallest fingerprint around each of its 65 words keeps every component. Components come from star
contraction in Spark; each round is written to the shared folder. Nothing about single documents reaches the driver.

``candidates`` is for callers that compare the texts afterwards: fingerprints that share a key and differ in more bits too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vecferry.llm.common import keep, returning, texts, written

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
GOLAY = 0xC75  # fixed value: generator polynomial of the perfect binary Golay code
FEW = 32
LOOSE = 10  # bits
SLAB_WORDS = 1 << 18


def _remainder(words: np.ndarray) -> np.ndarray:
    """The syndrome of 23-bit words: their remainder by the generator, 11 bits."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where((rest >> bit) & 1, GOLAY << (bit - 11), 0)
    return rest


def error_leaders() -> np.ndarray:
    """By syndrome the one error of at most 3 bits that has it."""
    one = 1 << np.arange(23)
    two = np.array([a | b for i, a in enumerate(one) for b in one[:i]])
    three = np.array([a | b for i, a in enumerate(two) for b in one if not a & b])
    errors = np.unique(np.concatenate([[0], one, two, three]))
    table = np.zeros(2048, np.int64)
    table[_remainder(errors)] = errors
    return table


def golay_keys(words: np.ndarray, leaders: np.ndarray) -> np.ndarray:
    """(n, 24) codeword numbers of the words within 1 bit; at most six differ per row."""
    around = words[:, None] ^ np.concatenate([[0], 1 << np.arange(23)])[None, :]
    return (around ^ leaders[_remainder(around)]) >> 11  # the code is systematic: 12 bits name a codeword


def fingerprint(bodies: list[bytes], size: int = 3) -> np.ndarray:
    """Fingerprints of texts in UTF-8, as signed 64-bit integers."""
    out = np.zeros(len(bodies), np.int64)
    slab: list[int] = []
    starts: list[int] = []
    owners: list[int] = []

    def add_up() -> None:
        if not slab:
            return
        bits = np.unpackbits(np.array(slab, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        n = np.diff([*starts, len(slab)])
        found = np.packbits(counts * 2 > n[:, None], axis=1, bitorder="little").view(np.int64).ravel()
        out[owners] = found
        slab.clear(), starts.clear(), owners.clear()

    digest = xxhash.xxh64_intdigest
    for i, body in enumerate(bodies):
        words = body.lower().split()  # bytes: A-Z and the six blanks alone
        if not words:
            continue
        if len(slab) + len(words) > SLAB_WORDS:
            add_up()
        if len(words) > SLAB_WORDS:  # a very long text by itself, in slabs
            counts, total = np.zeros(64, np.int64), len(words) - size + 1
            for at in range(0, total, SLAB_WORDS):
                part = [digest(b" ".join(words[j : j + size]), 42) for j in range(at, min(at + SLAB_WORDS, total))]
                counts += np.unpackbits(np.array(part, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0)
            out[i] = np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0]
            continue
        starts.append(len(slab))
        owners.append(i)
        if len(words) <= size:
            slab.append(digest(b" ".join(words), 42))
        else:
            slab.extend([digest(b" ".join(t), 42) for t in zip(*(words[j:] for j in range(size)), strict=False)])
    add_up()
    return out


def fingerprints(documents: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, fp``; texts without a word have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprint(bodies, size))], names=["doc_id", "fp"])

    return texts(documents).mapInArrow(returning(run), "doc_id long, fp long")


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of a set of shingle hashes, as a signed 64-bit integer."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLAB_WORDS):
        counts += np.unpackbits(hashes[at : at + SLAB_WORDS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    leaders = error_leaders()
    for batch in batches:
        fps = batch.column("fp").to_numpy()
        words = [(fps.view(np.uint64) >> np.uint64(at)).astype(np.int64) & ((1 << bits) - 1) for at, bits in SEGMENTS]
        keys, owners = [], []
        for s in range(3):
            codes = np.sort(golay_keys(words[(s + 1) % 3], leaders), axis=1)
            new = np.ones(codes.shape, bool)
            new[:, 1:] = codes[:, 1:] != codes[:, :-1]
            row, column = np.nonzero(new)
            keys.append((np.int64(s) << 36) | (words[s][row] << 12) | codes[row, column])
            owners.append(fps[row])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], names=["key", "fp"])


def candidates(distinct: DataFrame, few: int = 4) -> DataFrame:
    """Pairs ``a, b`` of fingerprints that share a key and are at most ``LOOSE`` bits apart, those of 2 bits and less among
    them, where up to ``few`` share it; of larger groups each with the smallest, so there some pairs are missing."""
    keyed = distinct.select("fp").mapInArrow(returning(_keys), "key long, fp long")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("least")).filter("n > 1")
    met = written(keyed.join(written(shared, "golay-shared"), "key"), "golay-met")
    small = met.filter(F.col("n") <= few)
    pairs = small.select("key", F.col("fp").alias("a")).join(small.select("key", F.col("fp").alias("b")), "key").filter("a < b").select("a", "b")
    stars = met.filter(F.col("n") > few).filter("least < fp").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= LOOSE).distinct()


def links(distinct: DataFrame, few: int = FEW) -> DataFrame:
    """Edges ``a, b`` between fingerprints at most 2 bits apart whose components are those of all such pairs."""
    keyed = written(distinct.select("fp").mapInArrow(returning(_keys), "key long, fp long"), "golay-keys")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = written(keyed.join(shared, "key"), "golay-groups")
    small = met.filter(F.col("n") <= few)
    pairs = small.select("key", F.col("fp").alias("a")).join(small.select("key", F.col("fp").alias("b")), "key")
    pairs = pairs.filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).select("a", "b")
    around = F.array(F.col("a"), *[F.col("a").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])
    large = met.filter(F.col("n") > few).select(F.col("fp").alias("a")).distinct()
    words = large.select("a", F.explode(around).alias("word"))
    least = words.groupBy("word").agg(F.min("a").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    stars = words.join(least, "word").filter("a != b").select("a", "b")
    return pairs.unionByName(stars).distinct()


def _digest(edges: DataFrame) -> tuple:
    """Whether two sets of edges are the same, without a shuffle: their number and two sums of row hashes that no order changes."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each component, for nodes with an edge. Large and small stars in turn."""
    edges = written(edges, "edges")
    seen = _digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select(F.col("b").alias("x"), "m").filter("x != m").select(F.col("x").alias("a"), F.col("m").alias("b"))
        after = written(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = _digest(after)
        edges = after
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def simhash_components(documents: DataFrame, size: int = 3, few: int = FEW) -> DataFrame:
    """A row per document: ``doc_id, fingerprint`` (hex), ``component_id``, the smallest ``doc_id`` reachable.

    Texts are lower-cased (A-Z) and cut into words at blanks; shingles are ``size`` words, repeats counted. A text with
    fewer words is one shingle; a text without a word, null or empty, has fingerprint 0 and is linked like any other.
    Links are transitive. A null ``doc_id`` is the name of a component only where all its members are null.
    """
    prints = written(fingerprints(documents, size), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct-fingerprints")
    roots = components(links(distinct, few))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    named = written(named, "named")
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = named.join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id")
    met = prints.join(classes, F.col("fp") == F.col("_fp"), "left")
    return met.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(documents: DataFrame, size: int = 3) -> DataFrame:
    """The documents with the smallest ``doc_id`` of their component, all their columns."""
    return keep(documents, simhash_components(documents, size).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))))
