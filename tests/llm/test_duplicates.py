"""Exact, near, passage, byte and line duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm.cases import documents, edge_rows, prose, with_clashing_columns
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from vecferry.llm import exact, lines, near, queries, simhash, substrings, suffixes, windows

SF_DIR = "/root/testdata/sf0.001"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == ""


# Exact copies


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], sha(t or "")) for i, t, *_ in rows), key=repr)


def test_exact_groups_on_edge_cases(spark):
    rows = edge_rows()
    for frame in (documents(spark, rows), with_clashing_columns(documents(spark, rows))):
        assert sorted(map(tuple, exact.exact_groups(frame).collect()), key=repr) == expected_groups(rows)
        stay = exact.exact_dedup(frame)
        assert stay.columns == frame.columns
        assert len({r.text or "" for r in stay.collect()}) == len({t or "" for _, t, *_ in rows})


def test_texts_that_share_a_key_are_told_apart_by_their_bytes(spark):
    rows = [(i, f"text {i % 40}") for i in range(200)]
    key = (F.crc32("text") % 4).cast("long")
    assert sorted(map(tuple, exact.exact_groups(documents(spark, rows), key=key).collect()), key=repr) == expected_groups(rows)


def test_directory_doubles_until_no_bucket_is_overfull():
    counts = Counter(random.Random(1).choices(range(256), k=4000))
    made = exact.build_directory(counts, 8, 100)
    assert len(made.slots) == 1 << made.depth and made.depth <= 8
    held = Counter()
    for prefix, n in counts.items():
        held[made.slots[prefix >> (8 - made.depth)]] += n
    assert all(n <= 100 or made.depths[b] == 8 for b, n in held.items())
    for bucket, depth in enumerate(made.depths):  # a bucket has the slots of one prefix
        assert made.slots.count(bucket) == 1 << (made.depth - depth)


def test_small_buckets_give_the_same_groups(spark):
    rows = [(i, f"text {i % 70}") for i in range(300)]
    entries, index, directory = exact.build_index(documents(spark, rows), bucket_rows=5)
    assert directory.depth > 2 and index.count() == 70 and entries.count() == 300
    assert index.groupBy("key").agg(F.countDistinct("bucket").alias("n")).filter("n > 1").count() == 0


def test_empty_tables(spark):
    none = documents(spark, [])
    assert exact.exact_groups(none).count() == 0
    assert lines.digest(lines.line_dedup(none)).count() == 0
    assert substrings.digest(substrings.passage_dedup(none)).count() == 0
    assert suffixes.digest(suffixes.byte_dedup(none)).count() == 0
    assert simhash.simhash_components(none).count() == 0


# Lines


def expected_lines(rows, min_chars, min_documents):
    blank = " \t\n\x0b\x0c\r"

    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(blank))

    holders = defaultdict(set)
    low = -(1 << 62)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(low if doc_id is None else doc_id)
    out = []
    for doc_id, text, *_ in rows:
        split = (text or "").split("\n")
        stay = [x for x in split if not (
            len(holders.get(key(x), ())) >= min_documents and max(holders[key(x)]) != (low if doc_id is None else doc_id))]
        out.append((doc_id, len(split), len(split) - len(stay), sha("\n".join(stay))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches,fan_in", [(1, 2), (4, 2), (5, 3)])
def test_line_dedup(spark, batches, fan_in):
    rnd = random.Random(batches)
    pool = [f"{'A' if i % 3 else 'a'} line {i} " + "x" * (i % 12) for i in range(25)] + ["", " \t", "short"]
    rows = [(i, "\n".join(rnd.choices(pool, k=rnd.randrange(6)))) for i in range(80)] + [(None, pool[3]), (80, None), (5, pool[4].upper())]
    rows[5:6] = []
    got = lines.digest(lines.line_dedup(documents(spark, rows), 10, 3, batches, fan_in))
    assert sorted(map(tuple, got.collect()), key=repr) == expected_lines(rows, 10, 3)


def test_line_dedup_edge_cases(spark):
    rows = edge_rows()
    frame = with_clashing_columns(documents(spark, rows))
    assert sorted(map(tuple, lines.digest(lines.line_dedup(frame, 3, 2)).collect()), key=repr) == expected_lines(rows, 3, 2)


def test_runs_are_compacted_by_level(spark):
    runs = lines.Runs(2)
    for i in range(5):
        runs.add(spark.createDataFrame([(bytes([i]),)], "hash binary"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r.hash for run in runs.all() for r in run.collect()) == [bytes([i]) for i in range(5)]


# Passages of words


def expected_passages(rows, size):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    first = {}
    for doc_id, words in split:
        at = 1 << 62 if doc_id is None else doc_id
        for i in range(len(words) - size + 1):
            w = tuple(words[i : i + size])
            first[w] = min(first.get(w, at), at)
    out = []
    for doc_id, words in split:
        gone = set()
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < (1 << 62 if doc_id is None else doc_id):
                gone.update(range(i, i + size))
        out.append((doc_id, len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("few", [windows.FEW, 1])
def test_passage_dedup(spark, few):
    rows = prose(7) + [(500, "a " * 300), (501, "a " * 200), (502, "a b " * 100), (503, "b a " * 100)]
    got = substrings.digest(substrings.passage_dedup(documents(spark, rows), size=12, gram=3, few=few))
    assert sorted(map(tuple, got.collect()), key=repr) == expected_passages(rows, 12)


def test_passage_dedup_edge_cases(spark):
    rows = edge_rows()
    got = substrings.digest(substrings.passage_dedup(with_clashing_columns(documents(spark, rows))))
    assert sorted(map(tuple, got.collect()), key=repr) == expected_passages(rows, 50)


# Strings of bytes


def expected_bytes(rows, size):
    bodies = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[i : i + size] for _, b in bodies for i in range(len(b) - size + 1))
    out = []
    for doc_id, body in bodies:
        gone = np.zeros(len(body) + 1, bool)
        for i in range(len(body) - size + 1):
            if seen[body[i : i + size]] > 1:
                gone[i : i + size] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((doc_id, len(body), int(gone.sum()), spans, sha(bytes(b for b, g in zip(body, gone) if not g))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("few", [windows.FEW, 1])
def test_byte_dedup(spark, few):
    rows = prose(3, 50, 40) + [(700, "ab" * 200), (701, "é" * 100), (702, "aab" * 90), (703, "q" * 31), (704, "zq" * 15 + "zq" * 15)]
    got = suffixes.digest(suffixes.byte_dedup(documents(spark, rows), size=40, gram=16, few=few))
    assert sorted(map(tuple, got.collect()), key=repr) == expected_bytes(rows, 40)


def test_byte_dedup_edge_cases(spark):
    rows = [r for r in edge_rows() if r[0] not in (7, 8)]
    got = suffixes.digest(suffixes.byte_dedup(with_clashing_columns(documents(spark, rows))))
    assert sorted(map(tuple, got.collect()), key=repr) == expected_bytes(rows, 200)


def test_byte_dedup_on_the_small_documents(spark):
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = suffixes.digest(suffixes.byte_dedup(frame))
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == expected_bytes(rows, 200)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7, 50, 200, 301])
def test_suffix_array(n):
    for seed, letters in ((1, 2), (2, 3), (3, 90)):
        s = np.random.default_rng(seed).integers(1, letters + 1, n)
        assert suffixes.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def test_minimisers_cover_every_window():
    h = np.random.default_rng(5).integers(0, 50, 400).astype(np.uint64)
    for grams in (1, 2, 5, 8, 13):
        first, n, value = windows.super_kmers(h, grams)
        least = np.array([h[i : i + grams].min() for i in range(len(h) - grams + 1)])
        assert np.repeat(value, n).tolist() == least.tolist() and first.tolist() == np.concatenate([[0], np.cumsum(n)[:-1]]).tolist()
        twice = windows.again_within(h, grams, first, n, value)
        for f, k, v, t in zip(first, n, value, twice):
            assert ((h[f : f + k + grams - 1] == v).sum() > 1) == t


# Near copies


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def expected_components(rows, prints):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        known = [x for x in (row[0], least.get(find(i))) if x is not None]
        least[find(i)] = min(known, default=None)
    return sorted(((row[0], f"{prints[i]:016x}", least[find(i)]) for i, row in enumerate(rows)), key=repr)


@pytest.mark.parametrize("few", [simhash.FEW, 2])
def test_simhash_components(spark, few):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    base = rows[3][1].split()
    rnd = random.Random(4)
    for i in range(80):  # a group of near copies, in which many fingerprints differ by a bit or two
        words = list(base)
        words[rnd.randrange(len(words))] = f"new{i}"
        rows.append((10_000 + i, " ".join(words)))
    got = simhash.simhash_components(documents(spark, rows), few=few)
    assert sorted(map(tuple, got.collect()), key=repr) == expected_components(rows, [plain_fingerprint(t) for _, t in rows])


def test_simhash_edge_cases(spark):
    rows = edge_rows()
    frame = with_clashing_columns(documents(spark, rows))
    got = simhash.simhash_components(frame)
    assert sorted(map(tuple, got.collect()), key=repr) == expected_components(rows, [plain_fingerprint(r[1]) for r in rows])
    assert simhash.simhash_dedup(frame).columns == frame.columns


def test_every_link_shares_a_key(spark):
    rnd = random.Random(9)
    prints = []
    for _ in range(150):
        a = rnd.getrandbits(64)
        b = a ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64))
        prints += [a, b]
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in set(prints)]
    for few in (simhash.FEW, 1):
        found = simhash.components(simhash.links(spark.createDataFrame(signed, "fp long"), few))
        root = {r.node: r.root for r in found.collect()}
        fix = lambda x: x - (1 << 64) if x >> 63 else x
        assert all(a == b or root[fix(a)] == root[fix(b)] for a, b in zip(prints[::2], prints[1::2]))


def test_golay_keys_of_near_words_meet():
    leaders = simhash.error_leaders()
    words = np.random.default_rng(2).integers(0, 1 << 23, 400)
    keys = simhash.golay_keys(words, leaders)
    assert max(len(set(k)) for k in keys.tolist()) == 6
    for a in range(23):
        for b in range(0, 23, 5):
            near = simhash.golay_keys(words ^ (1 << a) ^ (0 if a == b else 1 << b), leaders)
            assert all(set(x) & set(y) for x, y in zip(keys.tolist(), near.tolist()))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 103), (101, 103)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 103: 100}


# Similar shingles


def shingle_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def similar_groups(rows, percent=80):
    """The smallest identifier of each row's group, by comparing every pair of sets."""
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    known = defaultdict(list)
    for i, row in enumerate(rows):
        known[find(i)] += [] if row[0] is None else [row[0]]
    return [min(known[find(i)], default=None) for i in range(len(rows))]


def copies_at_all_similarities(rnd):
    """Texts with copies that differ in a few words, so that similarities lie on both sides of 0.8, and a large group."""
    rows = []
    for i in range(60):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([3, 9, 20, 60, 150]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rnd.randrange(4)):
            words = list(words)
            for _ in range(rnd.randrange(1, 2 + len(words) // 40)):
                words[rnd.randrange(len(words))] = f"v{rnd.randrange(3000)}"
            rows.append((len(rows), " ".join(words)))
    base = [f"g{i}" for i in range(100)]
    for i in range(90):
        words = list(base)
        for _ in range(rnd.randrange(1, 5)):
            words[rnd.randrange(100)] = f"u{rnd.randrange(10_000)}"
        rows.append((len(rows), " ".join(words)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("few,stars", [(near.FEW, near.STARS), (1, 1), (1, 0)])
def test_near_components(spark, few, stars):
    rows = copies_at_all_similarities(random.Random(6))
    got = near.near_components(documents(spark, rows), few=few, stars=stars)
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(zip([r[0] for r in rows], similar_groups(rows)))


def test_near_components_edge_cases(spark):
    rows = edge_rows()
    frame = with_clashing_columns(documents(spark, rows))
    got = Counter((r.doc_id, r.component_id) for r in near.near_components(frame).collect())
    assert got == Counter(zip([r[0] for r in rows], similar_groups(rows)))
    assert near.near_dedup(frame).columns == frame.columns
    assert near.near_components(documents(spark, [])).count() == 0


def counted(monkeypatch):
    """Collects the rows of every table that the near stage writes, by name."""
    rows = defaultdict(list)
    write = near.written

    def noted(table, name):
        out = write(table, name)
        rows[name].append(out.count())
        return out

    monkeypatch.setattr(near, "written", noted)
    return rows


def test_unrelated_texts_with_one_passage_are_not_compared_pair_by_pair(spark, monkeypatch):
    rnd = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(400):  # 56 common shingles of 57 to 75: some sizes reach the similarity, most don't
        own = [f"o{i}x{j}" for j in range(rnd.randrange(1, 20))]
        rows.append((i, " ".join(own + passage)))
    made = counted(monkeypatch)
    got = near.near_components(documents(spark, rows))
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(zip([r[0] for r in rows], similar_groups(rows)))
    assert sum(made["pairs"]) <= 2 * len(rows)


def test_texts_of_common_passages_in_different_mixes(spark, monkeypatch):
    rnd = random.Random(3)
    passages = [[f"p{k}w{i}" for i in range(40)] for k in range(4)]
    rows = []
    for i in range(240):
        chosen = rnd.sample(range(4), rnd.randrange(1, 4))
        rows.append((i, " ".join([f"o{i}x{j}" for j in range(rnd.randrange(8))] + [w for k in sorted(chosen) for w in passages[k]])))
    made = counted(monkeypatch)
    got = near.near_components(documents(spark, rows), few=1, stars=0)
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(zip([r[0] for r in rows], similar_groups(rows)))
    assert sum(made["pairs"]) <= 20 * len(rows)


def test_pipeline_stage_finds_all_similar_texts(spark):
    rows = copies_at_all_similarities(random.Random(8))
    rows += [(r.doc_id + 10_000, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), SF_DIR)
    assert sorted(r.doc_id for r in got.collect()) == sorted({g for g in similar_groups(rows)})


def test_pipeline_stage_links_by_simhash_first(spark, monkeypatch):
    """Fingerprints up to 2 bits apart meet; links are similar texts, and the stage's join starts from them."""
    rng = np.random.default_rng(4)
    fps = [int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 300)]
    flipped = [np.bitwise_xor.reduce([np.int64(fp), *(np.uint64(1 << int(b)).astype(np.int64) for b in rng.choice(64, rng.integers(1, 3), False))]) for fp in fps]
    frame = spark.createDataFrame([(int(x),) for x in [*fps, *flipped]], "fp long").distinct()
    found = {(r.a, r.b) for r in simhash.candidates(frame, few=1000).collect()}
    assert all(tuple(sorted((a, int(b)))) in found for a, b in zip(fps, flipped))
    assert {(r.a, r.b) for r in simhash.candidates(frame).collect()} <= found
    rows = copies_at_all_similarities(random.Random(8))
    made = counted(monkeypatch)
    got = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), SF_DIR)
    assert sorted(r.doc_id for r in got.collect()) == sorted({g for g in similar_groups(rows)})
    assert sum(made["simhash-links"]) > 0


@pytest.mark.parametrize("edges", [[], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 60), (60, 70), (50, 60)]])
def test_components_of_paths_stars_and_nothing(spark, edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    found = simhash.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {x: find(x) for x in root}
