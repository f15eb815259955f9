import numpy as np
import pytest

from vecferry.operators import pruned, search

DIM = 6


def clustered(seed=1, clusters=12, n=40):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 10, (clusters, DIM))
    return np.concatenate([c + rng.normal(0, 0.3, (n, DIM)) for c in centres]), centres


def frame(spark, rows, first=0, name="id"):
    return spark.createDataFrame([(first + i, [None if x is None else float(x) for x in v]) for i, v in enumerate(rows)], f"{name} long, vector array<float>")


def result(found, rank=True):
    return sorted((r.query_id, r["rank"] if rank else 0, r.id, r.score) for r in found.collect())


@pytest.fixture(scope="module")
def rows():
    vectors, centres = clustered()
    return [*vectors.tolist(), [0.0] * DIM, [0.0] * DIM, vectors[3].tolist(), [None] + [1.0] * (DIM - 1), [float("nan")] + [1.0] * (DIM - 1)], centres


@pytest.mark.parametrize("metric", ["L2", "COSINE"])
def test_nearest_are_those_of_brute_force_and_most_cells_are_skipped(spark, tmp_path, rows, metric):
    vectors, centres = rows
    items = frame(spark, vectors)
    asked = frame(spark, [*(centres[:5] + 0.2).tolist(), vectors[3], [0.0] * DIM], name="query_id")
    cells = pruned.build_bounded_cells(items, str(tmp_path / "cells"), 12, DIM, metric)
    for k in (1, 7, 60):
        assert result(pruned.pruned_knn(cells, asked, k)) == result(search.knn(items, asked, k, metric))
    near = pruned.skipped(cells, pruned.knn_pairs(cells, pruned._asked(cells, asked.filter("query_id < 5")), 7)).collect()
    assert len(near) == 5 and np.mean([r.skipped_share for r in near]) > 0.5
    assert all(r.visited_vectors == r.n_vectors for r in pruned.skipped(
        cells, pruned.knn_pairs(cells, pruned._asked(cells, asked.limit(1)), 10_000)).collect())  # more asked for than there are


def test_ranges_are_those_of_brute_force(spark, tmp_path, rows):
    vectors, centres = rows
    items, asked = frame(spark, vectors), frame(spark, [*centres[:4].tolist(), vectors[3], [99.0] * DIM], name="query_id")
    cells = pruned.build_bounded_cells(items, str(tmp_path / "cells"), 12, DIM)
    for low, high in ((0.0, 0.5), (0.4, 15.0), (12.0, 18.0), (500.0, 900.0)):
        assert result(pruned.pruned_range(cells, asked, low, high), False) == result(search.range_search(items, asked, low, high), False)
    narrow = pruned.skipped(cells, pruned.range_pairs(cells, pruned._asked(cells, asked), 0.0, 0.5)).collect()
    assert {r.query_id for r in narrow} <= set(range(5)) and min(r.skipped_share for r in narrow) > 0.5


def test_vectors_spread_evenly_skip_little_and_lose_nothing(spark, tmp_path):
    rng = np.random.default_rng(4)
    items, asked = frame(spark, rng.normal(size=(300, DIM))), frame(spark, rng.normal(size=(9, DIM)), name="query_id")
    for metric in ("L2", "COSINE"):
        cells = pruned.build_bounded_cells(items, str(tmp_path / metric), 5, DIM, metric)
        assert result(pruned.pruned_knn(cells, asked, 12)) == result(search.knn(items, asked, 12, metric))


def test_no_vectors_and_no_queries(spark, tmp_path):
    empty = frame(spark, []).select("id", "vector")
    asked = frame(spark, [[1.0] * DIM], name="query_id")
    cells = pruned.build_bounded_cells(frame(spark, [[1.0] * DIM]), str(tmp_path / "one"), 4, DIM)
    assert result(pruned.pruned_knn(cells, asked, 3)) == [(0, 1, 0, 0.0)]
    assert pruned.pruned_knn(cells, asked.filter("false"), 3).collect() == []
    assert empty.count() == 0
