import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecferry.operators import ann, fusion, scoring, search, text
from vecferry.operators.scoring import Dense, matches
from vecferry.plans import search as plans

RNG = np.random.default_rng(5)
ITEMS = RNG.normal(size=(400, 8))
ITEMS[::3] = ITEMS[0]  # a third of all rows are copies of one vector
QUERIES = RNG.normal(size=(6, 8))


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, v.tolist(), i % 4) for i, v in enumerate(ITEMS)]
    return spark.createDataFrame(rows, "id long, vector array<double>, label int").repartition(5)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(QUERIES)], "query_id long, vector array<double>")


def score(metric, v, q):
    if metric == "L2":
        return round(float(np.linalg.norm(v - q)), 6)
    if metric == "IP":
        return round(float(v @ q), 6)
    return round(float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), 6)


def expected(metric, k, keep=lambda i: True, group=lambda i: 0):
    sign = 1 if metric == "L2" else -1
    out = {}
    for qid, q in enumerate(QUERIES):
        groups = {}
        for s, i in sorted((sign * score(metric, v, q), i) for i, v in enumerate(ITEMS) if keep(i)):
            groups.setdefault(group(i), []).append((i, sign * s))
        out[qid] = sorted(pair for best in groups.values() for pair in best[:k])
    return out


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.id, r.score))
    return {q: sorted(pairs) for q, pairs in out.items()}


def same(left, right):
    assert left.keys() == right.keys()
    for q in left:
        assert [i for i, _ in left[q]] == [i for i, _ in right[q]]
        np.testing.assert_allclose([s for _, s in left[q]], [s for _, s in right[q]], atol=2e-6)


@pytest.mark.parametrize("metric", ["COSINE", "IP", "L2"])
@pytest.mark.parametrize("broadcast", [None, False])
def test_knn_equals_brute_force(vectors, queries, metric, broadcast):
    same(got(search.knn(vectors, queries, 7, metric, broadcast=broadcast)), expected(metric, 7))


def test_many_small_blocks_give_the_same(vectors, queries, monkeypatch):
    from vecferry.operators import scoring

    monkeypatch.setattr(scoring, "FEW_QUERIES", 1)
    monkeypatch.setattr(scoring, "MAX_BROADCAST_QUERIES", 2)
    monkeypatch.setattr(scoring, "BLOCK_ROWS", 40)
    monkeypatch.setattr(scoring, "CELLS_PER_STEP", 64)
    same(got(search.knn(vectors, queries, 7)), expected("COSINE", 7))
    same(got(search.knn(vectors, queries, 2, group="label")), expected("COSINE", 2, group=lambda i: i % 4))


def test_filter_and_groups(vectors, queries):
    filtered = search.knn(vectors, queries, 5, where=F.col("label") == 2, output_fields=["label"])
    assert {r.label for r in filtered.collect()} == {2}
    same(got(filtered), expected("COSINE", 5, keep=lambda i: i % 4 == 2))
    same(got(search.knn(vectors, queries, 3, group="label")), expected("COSINE", 3, group=lambda i: i % 4))


def test_groups_beyond_the_kept_rows(vectors, queries, monkeypatch):
    from vecferry.operators import scoring

    monkeypatch.setattr(scoring, "MAX_KEPT", 10)
    monkeypatch.setattr(scoring, "CELLS_PER_STEP", 90)
    each = vectors.withColumn("own", F.col("id"))
    assert search.knn(each, queries, 2, group="own").count() == len(ITEMS) * len(QUERIES)
    same(got(search.knn(vectors, queries, 3, group="label")), expected("COSINE", 3, group=lambda i: i % 4))


def test_text_ids_break_ties_in_order(spark):
    rows = [(name, [1.0, 0.0]) for name in ("d", "b", "a", "c")] + [("z", [0.0, 1.0])]
    items = spark.createDataFrame(rows, "id string, vector array<double>").repartition(3)
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<double>")
    for broadcast in (None, False):
        found = search.knn(items, asked, 3, broadcast=broadcast).orderBy("rank").collect()
        assert [r.id for r in found] == ["a", "b", "c"]


def test_range_search(vectors, queries):
    everything = expected("L2", len(ITEMS))
    wanted = {q: [(i, s) for i, s in pairs if 2.0 <= s < 3.0] for q, pairs in everything.items()}
    same(got(search.range_search(vectors, queries, 2.0, 3.0)), {q: p for q, p in wanted.items() if p})


def test_absent_vectors_never_match_and_wrong_lengths_fail(spark, queries):
    items = spark.createDataFrame([(1, [1.0] * 8), (2, None)], "id long, vector array<double>")
    assert {r.id for r in search.knn(items, queries, 5).collect()} == {1}
    ragged = spark.createDataFrame([(1, [1.0] * 7)], "id long, vector array<double>")
    with pytest.raises(Exception, match="dimensions"):
        search.knn(ragged, queries, 5).collect()


def test_hamming(spark):
    items = spark.createDataFrame([(i, bytearray([i])) for i in range(256)], "id long, vector binary")
    asked = spark.createDataFrame([(0, bytearray([0b10110001]))], "query_id long, vector binary")
    rows = search.knn(items, asked, 256, "HAMMING").collect()
    assert {r.id: r.score for r in rows} == {i: float(bin(i ^ 0b10110001).count("1")) for i in range(256)}


def test_no_queries_and_no_items(vectors, queries):
    assert search.knn(vectors, queries.limit(0), 3).count() == 0
    assert search.knn(vectors.limit(0), queries, 3).count() == 0
    assert search.knn(vectors.limit(0), queries, 3, broadcast=False).count() == 0


def test_iterate_returns_everything_in_order(vectors, queries):
    rows = search.iterate(vectors, queries.filter("query_id = 1"), 100).collect()
    order = sorted((-score("COSINE", v, QUERIES[1]), i) for i, v in enumerate(ITEMS))
    assert {r.id: r.batch for r in rows} == {i: n // 100 for n, (_, i) in enumerate(order)}


TEXTS = ["The cat, the dog!", "a cat", "dog dog dog bird", "Été à Paris", "nothing here", "", "cat " * 50]
ASKED = ["cat dog", "été", "absent", "the bird cat"]


def plain_bm25(texts, query):
    words = [re.findall(r"[^\W_]+", t.lower()) for t in texts]
    mean = sum(map(len, words)) / len(words)
    scores = {}
    for i, ws in enumerate(words):
        total, hit = 0.0, False
        for term in set(re.findall(r"[^\W_]+", query.lower())):
            df = sum(term in w for w in words)
            tf = ws.count(term)
            if tf:
                hit = True
                idf = math.log(1 + (len(texts) - df + 0.5) / (df + 0.5))
                total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / mean))
        if hit:
            scores[i] = round(total, 6)
    return scores


@pytest.mark.parametrize("broadcast", [None, False])
def test_bm25_equals_plain_formula(spark, broadcast):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    asked = spark.createDataFrame(list(enumerate(ASKED)), "query_id long, text string")
    rows = text.bm25_search(docs, asked, 10, broadcast=broadcast).collect()
    for q, query in enumerate(ASKED):
        found = {r.doc_id: r.score for r in rows if r.query_id == q}
        wanted = plain_bm25(TEXTS, query)
        assert found.keys() == wanted.keys()
        np.testing.assert_allclose([found[d] for d in sorted(found)], [wanted[d] for d in sorted(wanted)], atol=2e-6)


def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    from vecferry.operators import scoring

    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    asked = spark.createDataFrame(list(enumerate(ASKED)), "query_id long, text string")
    whole = sorted(map(tuple, text.bm25_search(docs, asked, 10).collect()))
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 40)
    assert sorted(map(tuple, text.bm25_search(docs, asked, 10, broadcast=False).collect())) == whole


def test_no_text_is_shuffled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plan = text.bm25_weights(docs)._jdf.queryExecution().toString()
    assert "REPARTITION" not in plan


def test_rare_and_common_words_by_two_joins(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    whole = {(r.doc_id, r.term): r.weight for r in text.bm25_weights(docs).collect()}
    monkeypatch.setattr(text, "FREQUENT", 3)
    split = {(r.doc_id, r.term): r.weight for r in text.bm25_weights(docs).collect()}
    assert split == whole and len(whole) > 8


def test_sparse_product_with_and_without_positive_weights(spark):
    docs = [(0, ["a", "b"], [1.0, 2.0]), (1, ["b"], [-1.0]), (2, ["c"], [5.0])]
    stored = spark.createDataFrame(docs, "doc_id long, t array<string>, w array<double>").select(
        "doc_id", F.map_from_arrays("t", "w").alias("sparse"))
    asked = spark.createDataFrame([(0, ["a", "b"], [0.5, 2.0])], "query_id long, terms array<string>, weights array<double>")
    rows = text.sparse_search(stored, asked, 5).collect()
    assert {r.doc_id: r.score for r in rows} == {0: 4.5, 1: -2.0}


def test_fusion_adds_reciprocal_ranks(spark):
    first = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], "query_id int, id int, rank int")
    second = spark.createDataFrame([(0, 2, 1), (0, 3, 2)], "query_id int, id int, rank int")
    rows = fusion.reciprocal_rank_fusion([first, second], "id", 2).orderBy("rank").collect()
    assert [r.id for r in rows] == [2, 1]
    assert rows[0].score == pytest.approx(1 / 61 + 1 / 62)


def embedded(spark):
    return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def mean_recall(found, exact):
    return ann.recall_at_k(found, exact).agg(F.avg("recall")).first()[0]


def test_cells_of_the_shipped_size_find_nine_tenths(spark, tmp_path):
    table = embedded(spark)
    asked = table.filter("id < 40").select(F.col("id").alias("query_id"), "vector")
    index = ann.build_cells(table, str(tmp_path / "cells"), plans.CELLS, plans.DIM)
    assert spark.read.parquet(index.path).count() == table.count()
    exact = search.knn(table, asked, 10)
    assert mean_recall(ann.ann_search(index, asked, 10, plans.PROBES), exact) >= 0.9
    assert mean_recall(ann.ann_search(index, asked, 10, plans.CELLS), exact) == 1.0


def test_cells_split_over_several_tasks_give_the_same(spark, tmp_path, monkeypatch):
    from vecferry.operators import scoring

    table = embedded(spark)
    asked = table.filter("id < 10").select(F.col("id").alias("query_id"), "vector")
    index = ann.build_cells(table, str(tmp_path / "cells"), 4, 64)
    whole = sorted(map(tuple, ann.ann_search(index, asked, 5, 2).collect()))
    monkeypatch.setattr(scoring, "BLOCK_ROWS", 30)
    assert sorted(map(tuple, ann.ann_search(index, asked, 5, 2).collect())) == whole


def test_centres_do_not_depend_on_the_layout(spark):
    table = embedded(spark)
    one, other = (ann.fit_centres(table.repartition(n), 64, 3, 5) for n in (1, 7))
    for left, right in zip(one, other):
        np.testing.assert_array_equal(left, right)


def test_k_means_rounds(spark):
    values = RNG.normal(size=(300, 7))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)] + [(300, None)], "id long, vector array<double>").repartition(4)
    books = ann.fit_centres(rows, 7, 3, 6)
    assert [b.shape for b in books] == [(6, 3), (6, 2), (6, 2)]  # no value is left out
    import hashlib

    start = sorted(range(300), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:6]
    for (at, width), book in zip(ann.slices(7, 3), books):
        part, centres = values[:, at : at + width], values[start, at : at + width]
        for _ in range(ann.ROUNDS):
            near = ((part[:, None] - centres[None]) ** 2).sum(2).argmin(1)
            centres = np.array([np.round(part[near == c].mean(0), 6) if (near == c).any() else centres[c] for c in range(6)])
        np.testing.assert_allclose(book, centres, atol=2e-6)
    coded = {r.id: r.codes for r in ann.quantize_pq(rows, books).collect()}
    assert coded[300] is None and len(coded[0]) == 3
    assert coded[5] == [int(((values[5, at : at + w] - b) ** 2).sum(1).argmin()) for (at, w), b in zip(ann.slices(7, 3), books)]


def test_product_codes_find_near_neighbours(spark):
    table = embedded(spark)
    asked = table.filter("id < 20").select(F.col("id").alias("query_id"), "vector")
    books = ann.fit_centres(table, 64, 16, 64)
    coded = ann.quantize_pq(table, books)
    assert coded.filter(F.size("codes") == 16).count() == table.count()
    exact = search.knn(table, asked, 10, "L2")
    assert mean_recall(ann.pq_search(coded, asked, books, 10, "L2"), exact) > 0.4
    assert mean_recall(ann.pq_search(coded, asked, books, 10, "L2", refine=8), exact) >= 0.9


def test_a_vector_with_a_null_element_matches_nothing(spark, queries):
    items = spark.createDataFrame([(1, [1.0] * 7 + [None]), (2, [-1.0] * 8)], "id long, vector array<double>")
    for metric in ("COSINE", "IP", "L2"):
        assert {r.id for r in search.knn(items, queries, 5, metric).collect()} == {2}


def test_fields_are_fetched_for_what_is_left(spark, vectors, queries):
    wide = vectors.withColumn("text", F.concat(F.lit("t"), "id"))
    for broadcast in (None, False):
        rows = search.knn(wide, queries, 2, group="label", output_fields=["text", "label"], broadcast=broadcast).collect()
        assert len(rows) == 6 * 4 * 2 and all(r.text == f"t{r.id}" for r in rows)


def test_eight_bit_codes(spark):
    df = spark.createDataFrame([(1, [0.0, 5.0]), (2, [1.0, 5.0]), (3, [0.5, 5.0])], "id int, vector array<double>")
    assert {r.id: r.code for r in ann.quantize_sq8(df).collect()} == {1: [0, 0], 2: [255, 0], 3: [128, 0]}


def test_scores_of_all_pairs_are_not_formed_as_rows(vectors, queries):
    plan = matches(vectors, queries, Dense("COSINE"), "id", k=3)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_every_vector_asks(spark):
    stored = plans.vectors(spark, "/root/testdata/sf0.001").collect()
    rows = plans.q_knn_all(spark, "/root/testdata/sf0.001").collect()
    asked = {}
    for r in rows:
        asked.setdefault(r.query_id, []).append(r.id)
    assert set(asked) == {r.id for r in stored}
    assert all(len(found) == 5 for found in asked.values())


def odd_vectors(n, seed, length):
    """Vectors with copies, near copies, zeros, missing and endless elements; ``length`` scales them."""
    rnd = np.random.default_rng(seed)
    vectors = rnd.normal(size=(n, 12))
    vectors[::7] = vectors[0]
    vectors[1::29] = vectors[1] + rnd.normal(size=vectors[1::29].shape) * 1e-7
    vectors[2::41], vectors[3::43, 4], vectors[5::47, 2] = 0, np.nan, np.inf
    return vectors * length


def arrow(name, ids, vectors):
    return pa.table({name: pa.array(ids), "vector": pa.array([[None if math.isnan(x) else x for x in v] for v in vectors], pa.list_(pa.float64()))})


def kept_by(asked, stored, text_ids=False, k=5):
    """What one task keeps, and of how many items it scored every query."""
    scored = []

    class Counted(Dense):
        def score(self, queries, rows):
            scored.append(rows.num_rows)
            return super().score(queries, rows)

    ids = np.random.default_rng(1).permutation(len(stored))
    stored = arrow("id", [f"{i:05}" for i in ids] if text_ids else ids, stored)
    schema = pa.schema([("query_id", pa.int64()), ("id", stored.schema.field("id").type), ("score", pa.float64())])
    keeper = scoring._Keeper(Counted("COSINE"), arrow("query_id", range(len(asked)), asked), "id", [], k, None, None)
    found = pa.concat_tables(keeper.run(iter([stored.slice(at, 700) for at in range(0, stored.num_rows, 700)]), schema))
    return sorted(zip(*(c.to_pylist() for c in found.columns), strict=True)), sum(scored)


@pytest.mark.parametrize("text_ids", [False, True])
@pytest.mark.parametrize("lengths", [(1, 1), (1e-30, 1e30), (1e-80, 1), (1, 1e90)])
def test_short_lists_change_no_result(monkeypatch, lengths, text_ids):
    asked, stored = odd_vectors(301, 3, lengths[0]), odd_vectors(3000, 4, lengths[1])
    monkeypatch.setattr(scoring, "CELLS_PER_STEP", 301 * 50)
    monkeypatch.setattr(scoring, "TILE", 128)
    short, _ = kept_by(asked, stored, text_ids)
    monkeypatch.setattr(Dense, "shortened", lambda *_: None, raising=False)
    whole, scored = kept_by(asked, stored, text_ids)
    assert scored == 3000
    assert [r[:2] for r in short] == [r[:2] for r in whole]
    np.testing.assert_allclose([r[2] for r in short], [r[2] for r in whole], atol=1e-9)


def test_short_lists_leave_most_pairs_unscored(monkeypatch):
    rnd = np.random.default_rng(6)
    monkeypatch.setattr(scoring, "CELLS_PER_STEP", 300 * 50)
    asked, stored = rnd.normal(size=(300, 64)), rnd.normal(size=(5000, 64))
    found, scored = kept_by(asked, stored)
    assert len(found) == 1500 and scored < 500


def test_alike_vectors_all_are_scored_as_a_whole(monkeypatch):
    monkeypatch.setattr(scoring, "CELLS_PER_STEP", 300 * 50)
    found, scored = kept_by(np.ones((300, 8)), np.ones((2000, 8)))
    assert scored == 2000 and [r[1] for r in found] == [0, 1, 2, 3, 4] * 300


def test_blocks_of_queries_meet_stripes_of_items(spark, monkeypatch):
    for name, value in (("SHORT_ROWS", 400), ("BLOCK_ROWS", 300), ("STRIPE_ROWS", 350), ("MAX_PARTS", 5)):
        monkeypatch.setattr(scoring, name, value, raising=False)
    rnd = np.random.default_rng(8)
    asked, stored = rnd.normal(size=(1000, 8)), rnd.normal(size=(1200, 8))
    stored[::5] = stored[0]
    frame = lambda name, rows: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], f"{name} long, vector array<double>")
    for metric in ("COSINE", "L2"):
        both = [search.knn(frame("id", stored), frame("query_id", asked), 4, metric, broadcast=b) for b in (None, False)]
        same(*map(got, both))
        assert "CoGroup" not in both[1]._jdf.queryExecution().toString()
