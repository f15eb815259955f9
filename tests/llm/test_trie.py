"""The conversation trie against plain dictionaries in Python."""

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from vecferry.llm import queries, trie

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, name string, top int, n_words string"


def expected(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(found)] for c, found in turns.items()}
    members = defaultdict(set)
    rebuilt = {}
    for c, mine in own.items():
        h = crc32(str(c).encode()) % 4
        first = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(own.get(first, [])[:h] + mine[h:])
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].add(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    out = []
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(members[node]) - 1) * words
        ends = ",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node))
        out.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]), leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def same(spark, rows, **options):
    got = [tuple(r) for r in trie.conversation_trie(frame(spark, rows), **options).collect()]
    assert sorted(got, key=repr) == sorted(expected(rows), key=repr)


def some(seed, n, deepest, symbols=3):
    rnd = random.Random(seed)
    made = []
    for _ in range(n):
        c = rnd.randrange(-30, 4 * n)
        for turn in range(rnd.randrange(deepest)):
            made.append((c, turn * 2 + rnd.randrange(2), rnd.choice(["user", "assistant"][: 1 + (symbols > 2)]), " ".join("ab" for _ in range(rnd.randrange(symbols)))))
    rnd.shuffle(made)
    return made


@pytest.mark.parametrize("seed, n, deepest, symbols, batches", [(1, 150, 9, 2, 3), (2, 60, 40, 2, 4), (3, 200, 5, 4, 1)])
def test_trie_is_that_of_plain_dictionaries(spark, seed, n, deepest, symbols, batches):
    same(spark, some(seed, n, deepest, symbols), batches=batches)


def test_edges_are_cut_at_every_depth(spark):
    chain = [(40 + c, t, "user", f"t{t} w") for c in range(0, 120, 7) for t in range(c // 2 + 1)]
    same(spark, chain)


def test_edge_cases(spark):
    rows = [
        (20, 0, "user", "hello there"), (20, 1, "assistant", None), (20, None, None, "first"), (20, None, None, "first"), (21, 0, "user", "hello there"),
        (22, 5, None, None), (23, 1, "", ""), (23, 1, "", ""), (24, 2, "user", "a\nb\x0bc  d"), (25, 2, "us", "era"), (26, 2, "use", "ra"), (None, 0, "user", "nobody"),
        (None, None, None, None), (41, 0, "user", "alone"), (43, 0, "user", "alone"), (44, 0, "user", "x"), (-7, 0, "user", "x"), (-20, 0, "user", "y"), (9_223_372_036_854_775_807, 0, "é", "é é")]
    assert any(crc32(str(c).encode()) % 4 > 1 for c in (41, 43, 44))  # their group has no first conversation: some have no turn left
    same(spark, rows)
    same(spark, rows[-7:-6], batches=2)
    assert trie.conversation_trie(frame(spark, [])).collect() == []
    assert trie.conversation_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []


def test_conversations_cut_by_range_boundaries(spark):
    rows = [(c, t, "user", f"t{t % 3} {t}") for c in (20, 21, 23, 57) for t in range(700)]
    shares = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        own = trie._own_turns(frame(spark, rows))
        assert [r["at"] for r in own.filter("conv_id = 21").orderBy("at").collect()] == list(range(1, 701))
        same(spark, rows, batches=2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", shares)


def test_large_groups_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    monkeypatch.setattr(trie, "RUN", 2)
    same(spark, [(20 + c, t, "user", "same") for c in range(100) for t in range(3 + c % 2 + crc32(str(20 + c).encode()) % 4)])


def test_two_fattest(spark):
    pairs = [(low, high) for low in range(40) for high in range(low + 1, 41)]
    got = spark.createDataFrame(pairs, "low long, high long").select("low", "high", trie.two_fattest("low", "high").alias("f"))
    for low, high, f in got.collect():
        assert f == max(range(low + 1, high + 1), key=lambda x: x & -x)


def test_rows_of_a_common_turn_meet_in_no_single_key(spark):
    rows = [(c, t, "user", "hi" if t == 0 else f"{c} {t}") for c in range(0, 2000, 20) for t in range(3)]
    got = trie.conversation_trie(frame(spark, rows))
    assert got.filter("depth = 1").select("n_convs", "n_children").collect() == [(100, 100)]
    assert got.filter(F.col("depth") == 3).count() == 100


def test_query_matches_sql(spark):
    name = "op13_conversation_trie"
    assert compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == ""
