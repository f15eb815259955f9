import random

import pytest
from pyspark.sql import functions as F

from vecferry.operators import digest_tree as dt
from vecferry.operators.reconcile import reconcile

KINDS = "k long, a string, b double, c array<int>"
COLUMNS = ["a", "b", "c"]


def rows(n=400):
    return [(k, None if k % 7 == 0 else f"t{k}", k / 3, [k, None]) for k in range(n)]


def frame(spark, made):
    return spark.createDataFrame(made, KINDS)


def leaves(spark, left, right, bits=8):
    sides = [dt.leaf_digests(frame(spark, r), "k", COLUMNS, bits) for r in (left, right)]
    return [r.leaf for r in dt.differing_leaves(*sides, bits).collect()]


def test_one_changed_row_reads_one_leaf_again(spark):
    before, after = rows(), rows()
    assert leaves(spark, before, after[::-1]) == []
    after[123] = (123, "other", 41.0, [123, None])
    found = leaves(spark, before, after)
    of = frame(spark, before).filter("k = 123").select(dt.leaf_of("k", 8)).first()[0]
    assert found == [of]
    read = frame(spark, before).filter(dt.leaf_of("k", 8) == of).count()
    assert 0 < read < 12
    assert sorted(map(tuple, dt.reconcile_by_digest(frame(spark, before), frame(spark, after), "k", COLUMNS, 8).collect())) == sorted(
        map(tuple, reconcile(frame(spark, before), frame(spark, after), "k", COLUMNS).collect()))


@pytest.mark.parametrize("change", [
    lambda made: made[:-1], lambda made: [*made, (9999, "x", 1.0, [])], lambda made: [*made, made[5]],
    lambda made: [(k, None, b, c) if k == 10 else (k, a, b, c) for k, a, b, c in made],
    lambda made: [(k, a, b, [None, k]) if k == 11 else (k, a, b, c) for k, a, b, c in made]])
def test_every_kind_of_change_is_found(spark, change):
    assert len(leaves(spark, rows(), change(rows()))) == 1


@pytest.mark.parametrize("bits", [1, 6, 12])
def test_same_counts_as_row_by_row(spark, bits):
    rnd = random.Random(bits)
    before = rows(300) + [(None, "nobody", None, None), (5, "again", 0.0, None)]
    after = [r for r in before if r[0] is None or r[0] % 41] + [before[3], (-1, "extra", None, None), (None, "nobody", None, None)]
    after = [(k, "changed" if rnd.random() < 0.02 else a, b, c) for k, a, b, c in after]
    left, right = frame(spark, before), frame(spark, after)
    wanted = {r.field: tuple(r) for r in reconcile(left, right, "k", COLUMNS).collect()}
    assert {r.field: tuple(r) for r in dt.reconcile_by_digest(left, right, "k", COLUMNS, bits).collect()} == wanted
    stored = dt.leaf_digests(left, "k", COLUMNS, bits)
    assert {r.field: tuple(r) for r in dt.reconcile_by_digest(left, right, "k", COLUMNS, bits, source_digests=stored).collect()} == wanted


def test_empty_sides(spark):
    for left, right in (([], []), (rows(20), []), ([], rows(20))):
        pair = frame(spark, left), frame(spark, right)
        assert sorted(map(tuple, dt.reconcile_by_digest(*pair, "k", COLUMNS).collect())) == sorted(map(tuple, reconcile(*pair, "k", COLUMNS).collect()))


def test_digesting_a_side_shuffles_no_rows(spark):
    plan = dt.leaf_digests(frame(spark, rows()), "k", COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
