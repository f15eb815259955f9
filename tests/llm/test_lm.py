"""Language-model scores against a plain trie in Python."""

import math
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from llm.cases import SCHEMA, documents, edge_rows, prose, with_clashing_columns

from vecferry.llm import lm


def read(text, order):
    """(tokens, bytes with the end symbols before them)."""
    words = (text or "").encode().lower().split()
    return [*words, b"\n"], b"\n" * order + b" ".join(words) + b"\n"


def held_out(doc_id):
    return crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def expected(rows, order):
    tokens, trie = Counter(), defaultdict(Counter)
    for doc_id, text, *_ in rows:
        if not held_out(doc_id):
            found, body = read(text, order)
            tokens.update(found)
            for at in range(order, len(body)):
                for length in range(order + 1):
                    trie[body[at - length : at]][body[at]] += 1
    total, distinct = sum(tokens.values()), len(tokens)

    def byte(context, symbol):
        score, gone = 0.0, set()
        for length in range(len(context), -1, -1):
            here = {s: c for s, c in trie[context[len(context) - length :]].items() if s not in gone}
            if not here:
                continue
            every = sum(here.values()) + len(here)
            if symbol in here:
                return score + math.log10(here[symbol] / every)
            score += math.log10(len(here) / every)
            gone |= set(here)
        return score - math.log10(256 - len(gone))

    out = []
    for doc_id, text, *_ in rows:
        found, body = read(text, order)
        base = sum(math.log10((tokens[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in found)
        score = sum(byte(body[at - order : at], body[at]) for at in range(order, len(body)))
        out.append((doc_id, held_out(doc_id), len(found), sum(tokens[t] > 0 for t in found), total, base, score))
    return out


def same(frame, rows, order):
    order_of = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got = sorted((tuple(r) for r in frame.collect()), key=order_of)
    wanted = sorted(expected(rows, order), key=order_of)
    assert [g[:5] for g in got] == [w[:5] for w in wanted]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in wanted], rtol=1e-9)


@pytest.mark.parametrize("order, hot", [(5, 1 << 20), (2, 0), (6, 300)])
def test_scores_are_those_of_a_plain_trie(spark, order, hot):
    rows = prose(order, n_documents=50, n_words=40)
    same(lm.score_texts(documents(spark, rows), order, hot_words=hot, hot_grams=hot), rows, order)


def test_edge_cases(spark):
    long = "Löng Straße\x0b" * 300
    rows = [r for r in edge_rows() if len(r[1] or "") < 10_000] + [(20, long, "a"), (21, "ONE one", "b"), (36, None, "a"), (46, "ünseen ÿ", None)]
    assert any(held_out(r[0]) for r in rows) and not all(held_out(r[0]) for r in rows)
    same(lm.score_texts(with_clashing_columns(documents(spark, rows)), 4), rows, 4)


def test_long_texts_are_read_whole_in_slabs(spark, monkeypatch):
    monkeypatch.setattr(lm, "SLAB", 7)
    split = [t.encode().split() for t in ("", "one two three four", "", "five", "x" * 40)]
    whole, slabs = lm.Sequence(5, split), []
    for low, high in whole.slabs():
        slabs.append(whole.codes(low, high))
    assert (np.concatenate(slabs) == whole.codes(0, whole.size)).all()
    assert (~whole.filler).sum() == sum(len(b" ".join(s)) + 1 for s in split)
    rows = [(i, " ".join(f"w{j % 50}" for j in range(i * 97))) for i in range(12)]
    same(lm.score_texts(documents(spark, rows), 5), rows, 5)


def test_nothing_to_learn_from_and_no_rows(spark):
    only = next(i for i in range(100) if held_out(i))
    row = lm.score_texts(documents(spark, [(only, "ab")])).first()
    assert row.base_score == 0 and row.train_tokens == 0 and row.n_known == 0
    assert row.score == pytest.approx(-3 * math.log10(256))
    assert lm.score_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_lookup_finds_what_it_holds_and_misses_the_rest():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 48, 5000))
    table = lm.Lookup(keys, np.arange(len(keys)) + 1.0)
    values, missing = table.get(np.concatenate([keys, keys + 1]))
    here = np.isin(keys + 1, keys)
    assert set(missing.tolist()) >= set((len(keys) + np.flatnonzero(~here)).tolist())
    lost = missing[missing < len(keys)]
    assert len(lost) < 50
    held = np.setdiff1d(np.arange(len(keys)), lost)
    assert (values[held] == held + 1).all()


def test_context_helps_on_documents_that_were_not_learned_from(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = lm.score_texts(frame).filter("held_out").selectExpr("sum(score) AS s", "sum(base_score) AS b", "count(*) AS n").first()
    assert held.n > 500 and held.s > held.b


def test_a_task_holds_the_words_of_few_texts(spark, monkeypatch):
    """What a task held grew with its batch: 10,000 texts as word objects, and a lookup with six slots for each key."""
    size, most = lm.Sequence.__init__, 500

    def bounded(self, order, split):
        assert len(split) <= 1 or sum(map(len, map(b" ".join, split))) <= most, len(split)
        size(self, order, split)

    monkeypatch.setattr(lm, "SLICE", most, raising=False)
    monkeypatch.setattr(lm.Sequence, "__init__", bounded)
    rows = [*prose(3, n_documents=40, n_words=30), (900, "y " * most, "a"), (901, None, "b"), (902, "z", "b")]
    frame = documents(spark, rows).coalesce(1)
    same(lm.score_texts(frame, 4), rows, 4)
    table = lm.Lookup(np.random.default_rng(3).permutation(1 << 18)[: 1 << 16], np.ones(1 << 16))
    assert sum(len(t[-1]) for t in table.tables) <= 3 << 16
