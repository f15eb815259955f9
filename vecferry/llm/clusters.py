"""Centroid clustering of integer vectors over subvector dictionaries, exact in every step.

The dimensions are cut into blocks of ``width``. Vectors are stored in chunks; a chunk holds, for every block, the
dictionary of the distinct subvectors that occur in it and one code per vector, which loses nothing. In a round the
distances of all subvectors of a dictionary to the centroids' subvectors are computed once; the distance of a vector is
the sum of its blocks' entries by code. New centroids come from counts per cluster and code, times the dictionary.

For scale: vectors are encoded once and written; they are never shuffled. A round reads the chunks where they lie, and a
task returns one row per cluster and dimension. Centroids, k times the dimensions, are all that the driver holds. A chunk
bounds the memory of a task, whatever the dictionaries' sizes are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vecferry.llm.common import written

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
WIDTH = 2
SCALE = 256
CHUNK = 1 << 16
LARGEST = 1 << 27  # of a component: squared distances of 64 such components fit a long

ENCODED = "ids array<long>, dictionaries array<binary>, codes array<binary>"


def _integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def usable(vectors: DataFrame, dimensions: int) -> DataFrame:
    """``vec_id, vector`` of the rows whose vector has all its components, none null or non-finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.filter((F.size("embedding") == dimensions) & F.coalesce(finite, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))


def _first_centroids(kept: DataFrame, clusters: int) -> list[list[int]]:
    """The vectors of the smallest digests of their names, at most ``clusters``; repeated names in order of their vectors."""
    name = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    chosen = kept.select(name.alias("name"), _integers(F.col("vector")).alias("vector")).orderBy("name", "vector").limit(clusters)
    return [r.vector for r in chosen.collect()]


def encode(kept: DataFrame, dimensions: int, width: int, chunk: int) -> DataFrame:
    """Chunks of vectors: per block a dictionary (int32) and the codes (unsigned, 16 or 32 bits as the dictionary needs)."""
    blocks = [(at, min(at + width, dimensions)) for at in range(0, dimensions, width)]

    def packed(ids: list, parts: list[np.ndarray]) -> pa.RecordBatch:
        found = np.concatenate(parts)
        dictionaries, codes = [], []
        for low, high in blocks:
            part = found[:, low:high]
            key = np.zeros(len(part), np.int64)  # a block of two fits a key; a wider one takes ranks of its halves
            for j in range(high - low):
                key = (np.unique(key, return_inverse=True)[1] << 32) + part[:, j].astype(np.int64) + (1 << 31)
            _, first, code = np.unique(key, return_index=True, return_inverse=True)
            dictionaries.append(np.ascontiguousarray(part[first]).tobytes())
            codes.append(code.astype("<u2" if len(first) <= 1 << 16 else "<u4").tobytes())
        return pa.RecordBatch.from_arrays([
            pa.array([ids], pa.list_(pa.int64())), pa.array([dictionaries], pa.list_(pa.binary())), pa.array([codes], pa.list_(pa.binary())),
        ], names=["ids", "dictionaries", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for batch in batches:
            column = batch.column("vector")
            scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
            if np.abs(scaled).max(initial=0) >= LARGEST:
                raise ValueError(f"a component of {LARGEST} or more: squared distances would not fit")
            found, names = scaled.astype("<i4").reshape(-1, dimensions), batch.column("vec_id").to_pylist()
            for at in range(0, len(names), chunk):
                ids.extend(names[at : at + chunk])
                parts.append(found[at : at + chunk])
                if len(ids) >= chunk:
                    yield packed(ids, parts)
                    ids, parts = [], []
        if ids:
            yield packed(ids, parts)

    return kept.mapInArrow(run, ENCODED)


def _chunks(batches: Iterator[pa.RecordBatch], width: int, dimensions: int):
    """(ids, [(subvectors, code of each vector) per block])."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column("ids")[i].values
            blocks = []
            for at, (values, code) in enumerate(zip(batch.column("dictionaries")[i].as_py(), batch.column("codes")[i].as_py(), strict=True)):
                wide = min(width, dimensions - at * width)
                subvectors = np.frombuffer(values, "<i4").reshape(-1, wide).astype(np.int64)
                blocks.append((subvectors, np.frombuffer(code, "<u2" if len(code) == 2 * len(ids) else "<u4")))
            yield ids, blocks


def _nearest(blocks: list, centroids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector of a chunk; of equally near centroids the first."""
    total = np.zeros((len(blocks[0][1]), len(centroids)), np.int64)
    for at, (subvectors, code) in enumerate(blocks):
        apart = np.zeros((len(subvectors), len(centroids)), np.int64)
        for j in range(subvectors.shape[1]):
            apart += (subvectors[:, j, None] - centroids[None, :, at * width + j]) ** 2
        total += apart[code]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(total)), cluster]


def _moved(chunks: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """The centroids after one round."""
    clusters, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, sums = np.zeros(clusters, np.int64), np.zeros((clusters, dimensions), np.int64)
        for _, blocks in _chunks(batches, width, dimensions):
            cluster, _ = _nearest(blocks, centroids, width)
            members += np.bincount(cluster, minlength=clusters)
            for at, (subvectors, code) in enumerate(blocks):
                held = np.bincount(cluster * len(subvectors) + code, minlength=clusters * len(subvectors))
                sums[:, at * width : at * width + subvectors.shape[1]] += held.reshape(clusters, -1) @ subvectors
        cluster, dimension = np.divmod(np.arange(clusters * dimensions), dimensions)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster), pa.array(dimension), pa.array(members[cluster]), pa.array(sums.ravel())], names=["cluster", "dimension", "n", "total"])

    parts = chunks.mapInArrow(run, "cluster long, dimension long, n long, total long")
    after = centroids.copy()
    for r in parts.groupBy("cluster", "dimension").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # k x dimensions
        if r.n:
            after[r.cluster, r.dimension] = r.total // r.n
    return after


def _assigned(chunks: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blocks in _chunks(batches, width, centroids.shape[1]):
            cluster, distance = _nearest(blocks, centroids, width)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return chunks.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, width: int = WIDTH, chunk: int = CHUNK,
) -> DataFrame:
    """A row per usable vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256``.

    Vectors of another length, null vectors and those with a null or non-finite component are left out. Components are
    floored after scaling by 256. Repeated rows each count and each return; a null ``vec_id`` is a name like any other, of
    no characters. With fewer vectors than clusters each is a centroid; an empty table gives no rows. Components of
    524,288 and more raise an error, as squared distances would not fit.
    """
    if width < 1:
        raise ValueError("a block has at least one dimension")
    kept = usable(vectors, dimensions)
    start = _first_centroids(kept, clusters)
    if not start:
        return kept.select(
            "vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.array().cast("array<long>").alias("centroid"), F.lit("").alias("centroid_sha256"))
    chunks = written(encode(kept, dimensions, width, chunk), "encoded")
    centroids = np.array(start, np.int64)
    for _ in range(rounds):
        centroids = _moved(chunks, centroids, width)
    assigned = written(_assigned(chunks, centroids, width), "assigned")
    sums = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per cluster
    named = [
        (i, sums.get(i, 0), sum(sums.values()), c, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())]
    of = vectors.sparkSession.createDataFrame(
        named, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")


def digest(clustered: DataFrame) -> DataFrame:
    return clustered.drop("centroid")
