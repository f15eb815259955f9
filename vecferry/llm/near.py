"""Near duplicates by the similarity of their word shingles, all of them: SimHash links, then an exact prefix join.

A text is its set of shingles. Two texts are linked when the Jaccard similarity of their sets reaches a threshold. Sets of
x and y elements that reach it share at least the threshold's part of either, so under any common order of the shingles
the first x - ceil(part of x) + 1 of one set and the same of the other share an element (prefix filter). Nothing that
follows is a sample; the filters leave out only texts that cannot have a partner, and every link is counted out.

SimHash links first: every text has a fingerprint of its set; of the texts that 1 and 2 leave in a group, those whose
fingerprints are 2 bits apart, and some with up to 10, meet by Golay keys (``simhash.candidates``) and are linked if they
are similar. Similar texts whose fingerprints are further apart, and those of large groups that met the smallest alone, are found by the
prefix join; it starts from the components that SimHash has found and compares what lies in different ones.

1. By hash order, with prefixes longer by ``spare``, two linked texts share that many elements more. A text without as many
   shingles that another text's prefix has as well is done.
2. For the texts left, shingles are ordered by how many texts have them, rare ones first. Shingles of one text alone fill
   the front of its prefix; a text whose whole prefix they fill is done. The others are grouped by the shingles there.
   For a pair whose first common shingle is the group's, all it can share is what either has from there on, its rest
   (positional filter): the smaller rest bounds the sizes that may meet. A text whose bound is below the smallest member
   leaves the group. So texts that share a passage, but are not similar, go without being compared.
3. Members with the same rest share exactly that: sizes alone decide. The smallest of them is linked with every member
   that is linked with any, so it stands for them; the others meet only those that stand for other rests.
4. Every text of a group is compared with one member, and components are formed. A group that lies in one component is
   done. This is repeated with other members while large groups are left; then every text outside the largest
   component of its group is compared with those that stand for the rests in other components, each pair in the group of
   its first common shingle, where counts of both sets by parts of the hashes leave room for the similarity.

For scale: texts with equal sets are one node. Large groups of near copies cost a comparison per member and shingle, not
per pair; a text that is not linked to the rest of a large group meets one member per distinct rest, as far as sizes
allow. Shingles are 64-bit hashes; texts are cut into them once, and those that may have partners once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from vecferry.llm.common import keep, returning, texts, written
from vecferry.llm.simhash import candidates, components, majority

FEW = 32
STARS = 4  # rounds of comparing with one member; what they leave is compared pair by pair
SPARE = 15  # per cent of a set
PARTS = 128
SLAB = 1 << 20  # shingles that leave a task together
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shingles(body: bytes, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; a text of fewer words, or none, is one shingle."""
    words = body.lower().split()  # bytes: A-Z and the six blanks alone
    if len(words) < size:
        words, size = [b" ".join(words)], 1
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    h = np.zeros(len(w) - size + 1, np.uint64)
    for j in range(size):
        h = (h ^ w[j : j + len(h)]) * K1
        h ^= h >> np.uint64(31)
    h *= K2
    return np.unique(h ^ (h >> np.uint64(29)))


def _node(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).view(np.int64))


def least_shared(n, percent: int):
    """How many elements of ``n`` a linked set must have as well."""
    return (percent * n + 99) // 100


def spare(n: int) -> int:
    return max(1, n * SPARE // 100)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    values = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(values))


def prints(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, node, n, fp, front``: the set of a text by its digest, its size, its fingerprint, and its lengthened prefix
    by hash order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, made, fronts, total = [], [], [], 0

            def table() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.int64()),
                     pa.array([m[2] for m in made], pa.int64()), _lists(fronts)], names=["doc_id", "node", "n", "fp", "front"])

            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                found = shingles(body.as_py(), size)
                n = len(found)
                ids.append(doc_id)
                made.append((_node(found), n, majority(found)))
                fronts.append(found[: n - least_shared(n, percent) + spare(n)])
                total += len(fronts[-1])
                if total > SLAB:
                    yield table()
                    ids, made, fronts, total = [], [], [], 0
            yield table()

    return texts(documents).mapInArrow(returning(run), "doc_id long, node long, n long, fp long, front array<long>")


def elements(documents: DataFrame, size: int) -> DataFrame:
    """``node, key``: the shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            owners: list[np.ndarray] = []
            total = 0

            def table() -> pa.RecordBatch:
                keys = np.concatenate(held).view(np.int64) if held else np.zeros(0, np.int64)
                of = np.concatenate(owners) if owners else np.zeros(0, np.int64)
                return pa.RecordBatch.from_arrays([pa.array(of), pa.array(keys)], names=["node", "key"])

            for body in batch.column("text").cast(pa.binary()):
                found = shingles(body.as_py(), size)
                held.append(found)
                owners.append(np.full(len(found), _node(found)))
                total += len(found)
                if total > SLAB:
                    yield table()
                    held, owners, total = [], [], 0
            yield table()

    return texts(documents).mapInArrow(returning(run), "node long, key long")


def entries(sets: DataFrame) -> DataFrame:
    """``key, node, n, rest, tail``: each place of a prefix, how many shingles the text has from there on, and their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, places, keys in zip(*(batch.column(c) for c in ("node", "n", "places", "keys")), strict=True):
                found = keys.values.to_numpy(zero_copy_only=False)
                mixed = found.view(np.uint64) * K1
                mixed = (mixed ^ (mixed >> np.uint64(29))) * K2
                tail = np.cumsum((mixed ^ (mixed >> np.uint64(32)))[::-1])[::-1].view(np.int64)
                at = min(places.as_py(), len(found))
                yield pa.RecordBatch.from_arrays([
                    pa.array(found[:at]), pa.array(np.full(at, node.as_py())), pa.array(np.full(at, n.as_py())),
                    pa.array(len(found) - np.arange(at)), pa.array(tail[:at])], names=["key", "node", "n", "rest", "tail"])

    return sets.mapInArrow(returning(run), "key long, node long, n long, rest long, tail long")


def _shared(rows: DataFrame) -> DataFrame:
    """``key, df`` of the keys that more than one node has."""
    met = rows.groupBy("key").agg(F.count("*").alias("df"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    return met.filter("lo < hi").select("key", "df")


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the similarity: shared / (n + n - shared) >= percent / 100."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("keys").alias("ka"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("keys").alias("kb"))
    common = F.size(F.array_intersect("ka", "kb"))
    return pairs.join(left, "a").join(right, "b").filter(
        common * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def profiles(sets: DataFrame) -> DataFrame:
    """``node, profile``: how many shingles of a set fall in each of ``PARTS`` parts of the hashes. Of two sets the smaller
    counts add up to no less than what they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.bincount((keys.values.to_numpy(zero_copy_only=False).view(np.uint64) * K2 >> np.uint64(40)).astype(np.int64) % PARTS, minlength=PARTS)
                    for keys in batch.column("keys")]
            flat = np.concatenate(made) if made else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1) * PARTS, pa.int32()), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), lists], names=["node", "profile"])

    return sets.select("node", "keys").mapInArrow(returning(run), "node long, profile array<int>")


def simhash_links(prints: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between similar nodes that SimHash finds; ``prints`` has ``node, fp``. Nodes with the same fingerprint
    meet the smallest of them, which meets those of other fingerprints."""
    distinct = written(prints.groupBy("fp").agg(F.min("node").alias("one")), "fingerprints")
    of = lambda end: distinct.select(F.col("fp").alias(end), F.col("one").alias(f"_{end}"))
    apart = candidates(distinct).join(of("a"), "a").join(of("b"), "b").select(*_pair("_a", "_b"))
    same = prints.join(distinct, "fp").filter("node != one").select(*_pair("node", "one"))
    return similar(written(apart.unionByName(same), "fingerprint-pairs"), sets, percent)


def _most(rest: str, percent: int) -> Column:
    """The largest sum of two sizes that this many shared shingles make similar."""
    return F.floor(F.col(rest) * (100 + percent) / percent)


def links(found: DataFrame, documents: DataFrame, size: int, percent: int, few: int = FEW, stars: int = STARS) -> DataFrame:
    """``node, root``: components of the nodes linked to another one."""
    every = found.groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.count("*").alias("copies"))
    # 1. Texts that can have a partner at all, by prefixes in hash order.
    front = found.select("node", F.explode("front").alias("key"))
    hits = front.join(written(_shared(front), "shared-prefixes").select("key"), "key").groupBy("node").agg(F.count("*").alias("hits"))
    smallest = F.floor((F.col("n") * percent + 99) / 100)
    need = F.greatest(F.lit(1), F.floor(smallest * SPARE / 100))
    left = written(hits.join(every, "node").filter(F.col("hits") >= need * F.col("copies")).select("node", "n", "fp"), "may-have-partners")
    # 2. Their sets without the shingles of one text alone, and prefixes with rare shingles first.
    ids = found.join(left.select("node"), "node", "left_semi").select("doc_id").distinct()
    full = elements(keep(documents, ids), size).join(left.select("node"), "node", "left_semi")
    full = written(full.distinct(), "elements")
    shared = full.join(_shared(full), "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("found"))
    rest = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1 - (F.col("n") - F.size("found"))
    sets = shared.join(left.drop("fp"), "node").withColumn("places", rest.cast("int")).filter("places > 0")
    sets = written(sets.select("node", "n", "places", F.col("found.key").alias("keys")), "sets")
    places = written(entries(sets), "places")
    least = places.groupBy("key").agg(F.count("*").alias("members"), F.min("n").alias("least")).filter("members > 1").drop("members")
    places = places.join(least, "key").filter(_most("rest", percent) - F.col("n") >= F.col("least")).drop("least")
    places = written(places, "near-places")
    groups = places.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    places = written(places.join(groups.select("key"), "key"), "groups")
    linked = left.join(places.select("node").distinct(), "node", "left_semi").select("node", "fp")
    linked = written(simhash_links(written(linked, "may-be-linked"), sets, percent), "simhash-links")
    # 3. Who stands for each rest; members that it is similar to by sizes alone, and those that SimHash has linked.
    heads = places.groupBy("key", "tail").agg(F.min(F.struct("n", "node")).alias("head"))
    heads = written(heads.select(F.col("key").alias("_key"), F.col("tail").alias("_tail"), F.col("head.node").alias("head"), F.col("head.n").alias("head_n")), "heads")
    met = places.join(heads, (F.col("key") == F.col("_key")) & (F.col("tail") == F.col("_tail"))).drop("_key", "_tail")
    sure = met.filter((F.col("node") != F.col("head")) & (F.col("n") + F.col("head_n") <= _most("rest", percent)))
    sure = sure.select(F.col("node").alias("a"), F.col("head").alias("b"))
    roots = written(components(sure.unionByName(linked).distinct()), "roots")
    # 4. Stars, then the pairs that they leave.
    fits = lambda n, rest, other_n, other_rest: F.col(n) + F.col(other_n) <= F.least(_most(rest, percent), _most(other_rest, percent))
    places = written(met.select("key", "node", "n", "rest", "head"), "placed")
    for turn in range(stars + 1):
        of = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        named = places.join(of, F.col("node") == F.col("_node"), "left").select("key", "node", "n", "rest", "head", F.coalesce("_root", "node").alias("root"))
        named = written(named, "named")
        # First the member that has the most of what all have, then others.
        least = F.struct(F.col("n") * percent - F.col("rest") * (100 + percent) if turn == 0 else F.xxhash64("node", F.lit(turn)), "node", "n", "rest")
        parts = named.groupBy("key", "root").agg(F.count("*").alias("size"), F.min(least).alias("one"))
        best = parts.groupBy("key").agg(
            F.count("*").alias("parts"), F.sum("size").alias("members"), F.max(F.struct("size", "root", "one")).alias("most")).filter("parts > 1")
        best = written(best.select(
            "key", F.col("most.root").alias("main"), F.col("most.one.node").alias("pivot"), F.col("most.one.n").alias("pivot_n"),
            F.col("most.one.rest").alias("pivot_rest"), (F.col("members") - F.col("most.size")).alias("others")), "mixed")
        mixed = named.join(best, "key")
        last = turn == stars or not best.filter(F.col("others") > few).take(1)
        if last:
            # Members that are in the component of their head meet others through it.
            # A pair meets in the group of its first common shingle alone, where rests bound what it shares.
            shared = mixed.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("rest")).alias("o"), "key"))), lambda x: x["key"]).alias("keys"))
            shared = shared.join(profiles(sets), "node").withColumnRenamed("node", "_of")
            mixed = written(mixed.join(shared, F.col("node") == F.col("_of")).drop("_of"), "meeting")
            asking = mixed.join(of.select(F.col("_node").alias("_of"), F.col("_root").alias("head_root")), F.col("head") == F.col("_of"), "left").filter(
                (F.col("node") == F.col("head")) | (F.col("root") != F.coalesce("head_root", "head")))
            stands = mixed.filter("node = head").select(*[F.col(c).alias(f"_{c}") for c in ("key", "node", "n", "rest", "root", "main", "keys", "profile")])
            first = F.element_at(F.array_intersect("keys", "_keys"), 1) == F.col("key")
            most = F.aggregate(F.zip_with("profile", "_profile", lambda x, y: F.least(x, y)), F.lit(0), lambda a, x: a + x)
            enough = most * (100 + percent) >= (F.col("n") + F.col("_n")) * percent
            meet = (F.col("key") == F.col("_key")) & (F.col("root") != F.col("_root")) & fits("n", "rest", "_n", "_rest") & first & enough
            pairs = asking.filter("root != main").join(stands, meet).unionByName(
                asking.filter("root = main").join(stands.filter("_root != _main"), meet)).select(*_pair("node", "_node"))
        else:
            pairs = mixed.filter("root != main").filter(fits("n", "rest", "pivot_n", "pivot_rest")).select(*_pair("node", "pivot"))
        edges = similar(written(pairs.distinct(), "pairs"), sets, percent)
        edges = edges.unionByName(roots.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = written(components(edges), "roots")
        if last:
            return roots


def near_components(documents: DataFrame, size: int = 5, percent: int = 80, few: int = FEW, stars: int = STARS) -> DataFrame:
    """A row per document: ``doc_id, node, component_id``, the smallest ``doc_id`` reachable.

    Texts are lower-cased (A-Z) and cut into words at blanks; a shingle is ``size`` words, and repeats count once. A text of
    fewer words is one shingle; texts without a word are alike. Links are transitive. A null ``doc_id`` is the name of a
    component only where all its members are null.
    """
    found = written(prints(documents, size, percent), "nodes")
    distinct = written(found.groupBy("node").agg(F.min("doc_id").alias("least")), "distinct-nodes")
    roots = links(found, documents, size, percent, few, stars).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    named = distinct.join(roots, distinct["node"] == F.col("_node"), "left").select("node", "least", F.coalesce("_root", "node").alias("root"))
    named = written(named, "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(smallest, "root").select(F.col("node").alias("_of"), "component_id")
    return found.join(classes, F.col("node") == F.col("_of"), "left").select("doc_id", "node", "component_id")


def near_dedup(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest ``doc_id`` of their component, all their columns."""
    return keep(documents, near_components(documents, size, percent).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))))
