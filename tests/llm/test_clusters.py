"""Clusters against plain integers in Python."""

import hashlib
import math

import numpy as np
import pytest
from oracle import compare, connect

from vecferry.llm import clusters, queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, cluster int, ids string, centroid string"


def expected(rows, k, rounds, dimensions):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(256 * x) for x in v]))
    name = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=name)[:k]]
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda v: min((apart(v, c), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for i in set(of):
            members = [v for (_, v), at in zip(kept, of, strict=True) if at == i]
            centroids[i] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    found = [(vec_id, *nearest(v)[::-1]) for vec_id, v in kept]
    every = sum(d for *_, d in found)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, sum(e for _, b, e in found if b == c), every, sha[c]) for i, c, d in found]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)


def same(spark, rows, k=4, rounds=5, dimensions=6, **options):
    got = clusters.digest(clusters.cluster_vectors(frame(spark, rows), k, rounds, dimensions, **options)).collect()
    order = lambda r: tuple((x is None, x or 0) for x in r[:3])
    assert sorted(map(tuple, got), key=order) == sorted(expected(rows, k, rounds, dimensions), key=order)


def some(seed, n, dimensions, spread=3):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) / 256 + 0.001 for x in row]) for i, row in enumerate(rng.integers(-spread, spread, (n, dimensions)))]


@pytest.mark.parametrize("width, chunk", [(1, 7), (2, 1000), (4, 50), (6, 33)])
def test_clusters_are_exact(spark, width, chunk):
    same(spark, some(width, 300, 6), width=width, chunk=chunk)


def test_far_components_and_many_distinct_subvectors(spark):
    rng = np.random.default_rng(3)
    same(spark, [(i, [float(x) for x in rng.normal(0, 1000, 6)]) for i in range(200)])
    with pytest.raises(Exception, match="would not fit"):
        clusters.cluster_vectors(frame(spark, [(1, [1e6] * 6)]), 2, 1, 6).collect()


def test_edge_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, None), (2, []), (3, [0.5] * 5), (4, [0.5] * 7), (5, [0.1, None, 0.1, 0.1, 0.1, 0.1]), (6, [inf] + [0.0] * 5), (7, [0.0] * 5 + [nan]),
        (8, [0.1] * 6), (8, [0.1] * 6), (8, [0.2] * 6), (None, [0.3] * 6), (None, [-0.3] * 6), (-9, [-0.001] * 6)]
    same(spark, rows, k=3)
    same(spark, rows, k=40)  # fewer vectors than clusters
    same(spark, [(i, [0.25] * 6) for i in range(50)], k=5)  # all alike: ties go to the first, empty clusters stay
    assert clusters.cluster_vectors(frame(spark, rows[:7]), 3, 2, 6).collect() == []
    empty = clusters.digest(clusters.cluster_vectors(frame(spark, []), 3, 2, 6))
    full = clusters.digest(clusters.cluster_vectors(frame(spark, rows), 3, 2, 6))
    assert empty.collect() == [] and empty.dtypes == full.dtypes


def test_dictionaries_lose_nothing(spark):
    rows = some(9, 500, 7)
    kept = clusters.usable(frame(spark, rows), 7).coalesce(1)
    found = []
    for chunk in clusters.encode(kept, 7, 3, 128).collect():
        blocks = [np.frombuffer(d, "<i4").reshape(-1, w)[np.frombuffer(c, "<u2")] for d, c, w in zip(chunk.dictionaries, chunk.codes, (3, 3, 1), strict=True)]
        assert len(chunk.ids) <= 128 and all(len(np.unique(b, axis=0)) * w * 4 == len(d) for b, d, w in zip(blocks, chunk.dictionaries, (3, 3, 1), strict=True))
        found += zip(chunk.ids, np.concatenate(blocks, axis=1).tolist(), strict=True)
    assert sorted(found) == sorted((i, [math.floor(256 * x) for x in v]) for i, v in rows)


def test_query_matches_sql(spark):
    name = "op12_centroid_clustering"
    assert compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == ""
