"""Scores of many items against a set of queries, without ever forming all pairs as rows.

Two exact ways, chosen by the measured size of the query side:
  * it fits the bound below: it is broadcast once, and every task scans its own items, keeping only
    the best k rows per query, so no item is shuffled;
  * otherwise queries are cut into blocks and items into stripes by hash; every block meets every stripe in
    one task, which holds the block, reads the stripe batch by batch and keeps only its best k rows per query.
A last window picks the best k of what the tasks kept.

For the best k by COSINE of many queries a product in single precision, with a bound on its error, first tells which
pairs may be among them; only those are scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from vecferry.session import written

FEW_QUERIES = 256  # taken to the driver unmeasured
MAX_BROADCAST_QUERIES = 16_384
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
BLOCK_ROWS = 16_384
BLOCK_BYTES = 32 * 1024 * 1024  # of a block, measured over the columns that travel
SHORT_ROWS = 65_536  # of a block of queries with a short list: their steps are cheap, and fewer blocks copy fewer items
STRIPE_ROWS = 1 << 20  # of the items that one task reads batch by batch
STRIPE_BYTES = 16 * BLOCK_BYTES
MAX_PARTS = 10_000  # more tasks than that share partitions
SMALLEST_BLOCK = 256
TILE = 2_048  # queries whose products with a step's items stay in the cache; a multiple of 8
CELLS_PER_STEP = 4_000_000  # size of the score matrix one step works on
SCORED_PAIRS = 16_384  # pairs of a short list that are scored at once
MAX_KEPT = 500_000  # rows a task holds back for groups
DIGITS = 6


class Dense:
    """COSINE, IP, L2 or HAMMING over equal-length vectors (HAMMING: packed bits)."""

    def __init__(self, metric: str, column: str = "vector"):
        self.metric, self.column = metric, column
        self.columns = [column]
        self.descending = metric in ("COSINE", "IP")

    def _matrix(self, rows: pa.Table) -> np.ndarray:
        column = rows.column(self.column).combine_chunks()
        if self.metric == "HAMMING":
            raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8)
            if len(raw) % len(column) or (pc.binary_length(column).to_numpy() != len(raw) // len(column)).any():
                raise ValueError(f"vectors in {self.column} differ in length")
            return np.unpackbits(raw.reshape(len(column), -1), axis=1).astype(np.float64) * 2 - 1
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null element is NaN: no match
        if len(values) % len(column):
            raise ValueError(f"vectors in {self.column} differ in length")
        return values.reshape(len(column), -1)

    def prepare(self, queries: pa.Table) -> np.ndarray:
        return self._matrix(queries)

    def shortened(self, vectors: np.ndarray) -> np.ndarray | None:
        """The vectors at length 1 in single precision, NaN where nothing matches; None if there can be no short list.

        Products of such rows differ from the scores by less than ``slack``. Lengths that over- or underflow get none.
        """
        if self.metric != "COSINE":
            return None
        squares = np.einsum("ij,ij->i", vectors, vectors)
        plain = (squares == 0) | ((squares > 1e-140) & (squares < 1e140))
        if not (plain | ~np.isfinite(vectors).all(axis=1)).all():
            return None
        lengths = np.sqrt(np.where(squares == 0, 1.0, np.where(plain, squares, np.nan)))
        return np.where((squares == 0)[:, None], 0.0, vectors / lengths[:, None]).astype(np.float32)

    @staticmethod
    def slack(dimensions: int) -> float:
        """Two roundings of elements and one per sum to 24 bits, of the score to ``DIGITS``, and of the bound itself."""
        return (dimensions + 8) * 2.0**-24 + 10.0**-DIGITS

    def score_pairs(self, queries: np.ndarray, items: np.ndarray, query: np.ndarray, item: np.ndarray) -> np.ndarray:
        """COSINE of single pairs, as ``score`` has it."""
        scores = np.empty(len(query))
        for at in range(0, len(query), SCORED_PAIRS):
            q, x = queries[query[at:at + SCORED_PAIRS]], items[item[at:at + SCORED_PAIRS]]
            products = np.einsum("ij,ij->i", x, q)
            lengths = np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", q, q))
            scores[at:at + SCORED_PAIRS] = np.divide(products, lengths, out=np.zeros_like(products), where=lengths > 0)
        return scores

    def score(self, queries: np.ndarray, rows: pa.Table) -> np.ndarray:
        items = self._matrix(rows)
        if items.shape[1] != queries.shape[1]:
            raise ValueError(f"vectors have {items.shape[1]} dimensions, queries {queries.shape[1]}")
        products = items @ queries.T
        if self.metric == "IP":
            return products
        if self.metric == "HAMMING":
            return (items.shape[1] - products) / 2
        item_squares = np.einsum("ij,ij->i", items, items)[:, None]
        query_squares = np.einsum("ij,ij->i", queries, queries)[None, :]
        if self.metric == "L2":
            return np.sqrt(np.maximum(item_squares + query_squares - 2 * products, 0.0))
        lengths = np.sqrt(item_squares * query_squares)
        scores = np.divide(products, lengths, out=np.zeros_like(products), where=lengths > 0)
        return np.where(np.isnan(products), np.nan, scores)


class Sparse:
    """Inner product over sparse vectors given as term and weight lists; only shared terms count."""

    descending = True

    def __init__(self, terms: str = "terms", weights: str = "weights"):
        self.terms, self.weights = terms, weights
        self.columns = [terms, weights]

    def shortened(self, _) -> None:
        return None

    def prepare(self, queries: pa.Table):
        terms = queries.column("terms").combine_chunks()
        flat = terms.flatten()
        vocabulary = flat.unique()
        codes = pc.index_in(flat, value_set=vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        weights = queries.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
        by_term = np.argsort(codes, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(vocabulary)))])
        grid = None
        if len(vocabulary) * len(terms) <= CELLS_PER_STEP and (weights > 0).all():
            grid = np.zeros((len(vocabulary), len(terms)))
            np.add.at(grid, (codes, owner), weights)
        return vocabulary, starts, owner[by_term], weights[by_term], len(terms), grid

    @staticmethod
    def _by_product(grid: np.ndarray, item, code, weight, n_rows: int) -> np.ndarray:
        """Few words were asked for: a plain matrix product is fastest. Positive weights make 0 mean no match."""
        scores = np.empty((n_rows, grid.shape[1]))
        step = max(1, CELLS_PER_STEP // max(len(grid), 1))
        for start in range(0, n_rows, step):
            here = (item >= start) & (item < start + step)
            block = np.zeros((min(step, n_rows - start), len(grid)))
            np.add.at(block, (item[here] - start, code[here]), weight[here])
            scores[start:start + step] = block @ grid
        scores[scores == 0] = np.nan
        return scores

    def _postings(self, rows: pa.Table, vocabulary: pa.Array):
        terms = rows.column(self.terms).combine_chunks()
        codes = pc.index_in(terms.flatten(), value_set=vocabulary)
        known = codes.is_valid().to_numpy(zero_copy_only=False)
        item = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))[known]
        code = pc.fill_null(codes, 0).to_numpy(zero_copy_only=False).astype(np.int64)[known]
        return item, code, rows.column(self.weights).combine_chunks().flatten().to_numpy(zero_copy_only=False)[known]

    def score(self, queries, rows: pa.Table) -> np.ndarray:
        vocabulary, starts, owner, weights, n_queries, grid = queries
        item, code, weight = self._postings(rows, vocabulary)
        if grid is not None and (weight > 0).all():
            return self._by_product(grid, item, code, weight, rows.num_rows)
        fan_out = starts[code + 1] - starts[code]
        posting = np.repeat(np.arange(len(code)), fan_out)
        inside = np.arange(len(posting)) - np.repeat(np.cumsum(fan_out) - fan_out, fan_out)
        entry = starts[code][posting] + inside
        cell = item[posting] * n_queries + owner[entry]
        size = rows.num_rows * n_queries
        scores = np.bincount(cell, weights=weight[posting] * weights[entry], minlength=size)
        scores[np.bincount(cell, minlength=size) == 0] = np.nan
        return scores.reshape(rows.num_rows, n_queries)


def _places(*sorted_keys: np.ndarray) -> np.ndarray:
    """Position of every row in its run of equal keys."""
    at = np.arange(len(sorted_keys[0]))
    changed = np.ones(len(at), dtype=bool)
    changed[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in sorted_keys])
    return at - np.maximum.accumulate(np.where(changed, at, 0))


class _Found(NamedTuple):
    """Query position, cost (lower is better) and item columns of candidate rows."""

    query: np.ndarray
    cost: np.ndarray
    rows: pa.Table


class _Keeper:
    """The rows of one task that may still be among the results."""

    def __init__(self, scorer, queries: pa.Table, id_column, carry, k, group, band):
        self.scorer, self.state = scorer, scorer.prepare(queries)
        self.query_ids = queries.column("query_id").combine_chunks()
        self.id_column, self.carry, self.k, self.group, self.band = id_column, carry, k, group, band
        self.sign = -1.0 if scorer.descending else 1.0
        self.kept: _Found | None = None
        self.worst = np.full(len(self.query_ids), np.inf)  # cost of the k-th best so far
        self.worst_id: np.ndarray | None = None
        self.waiting: list[_Found] = []  # found by short lists, not yet among what is kept
        self.short: np.ndarray | None = None
        if k is not None and group is None and band is None and len(self.worst) > FEW_QUERIES:
            self.short = scorer.shortened(self.state)
        if self.short is not None:
            self.short = np.concatenate([self.short, np.zeros((-len(self.short) % 8, self.short.shape[1]), np.float32)])
            self._set_floor()

    def _ids(self, rows: pa.Table) -> np.ndarray:
        ids = rows.column(self.id_column).to_pandas()
        return ids.to_numpy() if ids.dtype.kind in "iu" else ids.rank(method="dense").to_numpy()

    def _candidates(self, rows: pa.Table) -> _Found:
        scores = np.round(self.scorer.score(self.state, rows), DIGITS) + 0.0
        cost = np.where(np.isnan(scores), np.inf, self.sign * scores)
        if self.band is not None:
            wanted = (scores >= self.band[0]) & (scores < self.band[1])
        else:
            wanted = cost < np.inf
        if self.k is not None and self.group is None:
            if self.worst_id is not None:
                earlier = rows.column(self.id_column).to_numpy()[:, None] < self.worst_id[None, :]
                wanted &= (cost < self.worst) | ((cost == self.worst) & earlier)
            else:
                wanted &= cost <= self.worst
            if len(cost) > self.k and wanted.sum() > 4 * self.k * len(self.worst):
                wanted &= cost <= np.partition(cost, self.k - 1, axis=0)[self.k - 1]
        item, query = np.nonzero(wanted)
        plain = rows.select([self.id_column, *self.carry])
        return _Found(query, cost[item, query], plain.take(pa.array(item)))

    def _set_floor(self) -> None:
        """Products below are not among the results; the rows that fill up the last eight queries have none."""
        self.floor = np.full(len(self.short), np.inf, np.float32)
        self.floor[:len(self.worst)] = -self.worst - self.scorer.slack(self.short.shape[1])

    def _shortlisted(self, rows: pa.Table) -> _Found | None:
        """The rows that may still be among the results, by a product in single precision; None if those are too many."""
        items = self.scorer.prepare(rows)
        if items.shape[1] != self.short.shape[1]:
            return None
        short = self.scorer.shortened(items)
        if short is None:
            return None
        item, query, most = [], [], len(items) * len(self.worst) // 8
        for low in range(0, len(self.short), TILE):
            near = (short @ self.short[low:low + TILE].T >= self.floor[low:low + TILE]).reshape(-1, 8)
            eights = np.flatnonzero(near.view(np.uint64))
            eight, bit = np.nonzero(near[eights])
            at, of = np.divmod(eights[eight] * 8 + bit, min(TILE, len(self.short) - low))
            item.append(at)
            query.append(of + low)
            most -= len(at)
            if most < 0:
                return None
        item, query = np.concatenate(item), np.concatenate(query)
        cost = self.sign * (np.round(self.scorer.score_pairs(self.state, items, query, item), DIGITS) + 0.0)
        worst = self.worst[query]
        if self.worst_id is not None:
            wanted = (cost < worst) | ((cost == worst) & (rows.column(self.id_column).to_numpy()[item] < self.worst_id[query]))
        else:
            wanted = cost <= worst
        plain = rows.select([self.id_column, *self.carry])
        return _Found(query[wanted], cost[wanted], plain.take(pa.array(item[wanted])))

    def _keep(self, *found: _Found) -> None:
        """Takes in what was found and what is waiting."""
        parts = [part for part in (self.kept, *self.waiting, *found) if part is not None and len(part.query)]
        self.waiting = []
        if not parts:
            return
        found = _Found(*map(np.concatenate, list(zip(*parts, strict=True))[:2]), pa.concat_tables([part.rows for part in parts]))
        runs = [found.query]
        if self.group:
            runs.append(pd.factorize(found.rows.column(self.group).to_pandas())[0])
        order = np.lexsort((self._ids(found.rows), found.cost, *reversed(runs)))
        order = order[_places(*[run[order] for run in runs]) < self.k]
        self.kept = _Found(found.query[order], found.cost[order], found.rows.take(pa.array(order)))
        if not self.group:
            self._remember_worst()

    def _remember_worst(self) -> None:
        query, cost, rows = self.kept
        counts = np.bincount(query, minlength=len(self.worst))
        full = np.flatnonzero(counts == self.k)
        last = np.cumsum(counts)[full] - 1
        self.worst[full] = cost[last]
        if pa.types.is_integer(rows.schema.field(self.id_column).type):
            if self.worst_id is None:
                self.worst_id = np.full(len(self.worst), np.iinfo(np.int64).max)
            self.worst_id[full] = rows.column(self.id_column).to_numpy()[last]
        if self.short is not None:
            self._set_floor()

    def _result(self, found: _Found, schema: pa.Schema) -> pa.Table:
        columns = [self.query_ids.take(pa.array(found.query)), *found.rows.columns, pa.array(self.sign * found.cost + 0.0)]
        return pa.table(columns, names=schema.names).cast(schema)

    def run(self, tables: Iterator[pa.Table], schema: pa.Schema) -> Iterator[pa.Table]:
        step = max(1, CELLS_PER_STEP // max(len(self.worst), 1))
        for rows in tables:
            # Absent vectors are left out here: as a filter in the plan this would work out a computed column twice.
            present = rows.filter(pc.is_valid(rows.column(self.scorer.columns[0])))
            for start in range(0, present.num_rows, step):
                part = present.slice(start, step)
                found = None if self.short is None else self._shortlisted(part)
                if found is not None:
                    self.waiting.append(found)
                    if sum(len(f.query) for f in self.waiting) > 2 * len(self.worst):
                        self._keep()
                    continue
                found = self._candidates(part)
                if self.k is None:
                    yield self._result(found, schema)
                else:
                    self._keep(found)
                    if self.group and self.kept is not None and len(self.kept.query) > MAX_KEPT:
                        # Groups have no bound: hand on what is kept; the last window still sees every candidate.
                        yield self._result(self.kept, schema)
                        self.kept = None
        if self.waiting:
            self._keep()
        if self.kept is not None:
            yield self._result(self.kept, schema)


def _fits(queries: DataFrame) -> tuple[pa.Table | None, DataFrame]:
    """The query side if it is small enough to broadcast, and where to read it otherwise; it is worked out once.

    A few rows come to the driver as they are. More are written first and measured before they do.
    """
    few = queries.limit(FEW_QUERIES + 1).toArrow()
    if few.num_rows <= FEW_QUERIES:
        return (few if few.nbytes <= MAX_BROADCAST_BYTES else None), queries
    queries = written(queries, "queries")
    n_rows, n_bytes = _measured(queries)
    return (queries.toArrow() if n_rows <= MAX_BROADCAST_QUERIES and n_bytes <= MAX_BROADCAST_BYTES else None), queries


def matches(
    items: DataFrame, queries: DataFrame, scorer, id_column: str, carry: list[str] | None = None, k: int | None = None,
    group: str | None = None, band: tuple[float, float] | None = None, broadcast: bool | None = None, derived: bool = False,
) -> DataFrame:
    """Rows ``query_id, <id>, <carry...>, score`` and, with ``k``, ``rank``.

    ``k``: the best k per query, or per query and ``group`` value. ``band``: all with low <= score < high.
    Neither: every score. Ties go to the lower id. ``broadcast=False`` forces the block way, in which both sides are
    measured first; items that are ``derived``, not read, are then written so that they are worked out once.
    """
    wanted = [c for c in dict.fromkeys(carry or []) if c not in (group, id_column)]
    if wanted and k is not None:
        # A task may hold an item once per query and group: only ids travel, fields are fetched for what is left.
        best = matches(items, queries, scorer, id_column, None, k, group, None, broadcast, derived)
        return best.join(items.select(id_column, *wanted), id_column).select(
            "query_id", id_column, *[c for c in dict.fromkeys(carry) if c != id_column], *([group] if group and group not in carry else []), "score", "rank")
    carry = list(dict.fromkeys([*(carry or []), *([group] if group else [])]))
    items = items.select(id_column, *[c for c in carry if c != id_column], *[c for c in scorer.columns if c not in carry])
    carry = [c for c in carry if c != id_column]
    types = {f.name: f.dataType for f in items.schema.fields}
    out = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField(id_column, types[id_column]),
        *[T.StructField(c, types[c]) for c in carry], T.StructField("score", T.DoubleType()),
    ])
    arrow_out = to_arrow_schema(out)

    def keeper(query_table: pa.Table) -> _Keeper:
        return _Keeper(scorer, query_table, id_column, carry, k, group, band)

    small, queries = (None, written(queries, "queries")) if broadcast is False else _fits(queries)
    if small is not None:
        found = _scan(items, small, keeper, out, arrow_out)
    else:
        items = written(items, "items") if derived else items
        shortens = k is not None and group is None and band is None and getattr(scorer, "metric", "") == "COSINE"
        found = _meet_in_blocks(items, queries, keeper, id_column, out, arrow_out, SHORT_ROWS if shortens else BLOCK_ROWS)
    if k is None:
        return found
    return _best(found, scorer, id_column, k, group)


def _best(found: DataFrame, scorer, id_column: str, k: int, group: str | None = None) -> DataFrame:
    order = [F.col("score").desc() if scorer.descending else F.col("score").asc(), F.col(id_column).asc()]
    window = Window.partitionBy("query_id", *([group] if group else [])).orderBy(*order)
    return found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def _scan(items: DataFrame, queries: pa.Table, keeper: Callable, out: T.StructType, arrow_out: pa.Schema) -> DataFrame:
    shared = items.sparkSession.sparkContext.broadcast(queries)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value.num_rows == 0:
            return
        tables = (pa.Table.from_batches([b]) for b in batches if b.num_rows)
        for found in keeper(shared.value).run(tables, arrow_out):
            yield from found.to_batches()

    return items.mapInArrow(score, out)


def _measured(rows: DataFrame) -> tuple[int, int]:
    """Rows, and their bytes as the sum of what their texts, lists and numbers take."""

    def size(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, T.StringType):
                return F.coalesce(F.octet_length(F.array_join(column, "____")), F.lit(0)).cast("long")
            return F.coalesce(F.size(column), F.lit(0)).cast("long") * 8
        return F.lit(8).cast("long")

    total = sum((size(f) for f in rows.schema.fields[1:]), size(rows.schema.fields[0]))
    found = rows.agg(F.count("*").alias("n"), F.sum(total).alias("bytes")).first()
    return found.n, found.bytes or 0


def _block(column: str, blocks: int):
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def _every(blocks: int):
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def _meet(left: DataFrame, right: DataFrame, keys: list[str], keeper: Callable, out: T.StructType, arrow_out: pa.Schema) -> DataFrame:
    def score(item_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        empty = arrow_out.empty_table()
        if not item_rows.num_rows or not query_rows.num_rows:
            return empty
        return pa.concat_tables([empty, *keeper(query_rows).run(iter([item_rows]), arrow_out)])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, out)


def _meet_in_blocks(
    items: DataFrame, queries: DataFrame, keeper: Callable, id_column: str, out: T.StructType, arrow_out: pa.Schema,
    most_queries: int = BLOCK_ROWS,
) -> DataFrame:
    """Every block of queries meets every stripe of items, both bounded in rows and in bytes; a task reads its block first.

    There are enough of both to keep all cores busy, in the proportion that copies the fewest rows.
    """
    (n_queries, query_bytes), (n_items, item_bytes) = _measured(queries), _measured(items)
    tasks = 4 * items.sparkSession.sparkContext.defaultParallelism
    busy = min(round((tasks * n_queries / max(n_items, 1)) ** 0.5), n_queries // SMALLEST_BLOCK)
    blocks = max(1, -(-n_queries // most_queries), -(-query_bytes // BLOCK_BYTES), busy)
    busy = min(-(-tasks // blocks), n_items // SMALLEST_BLOCK)
    stripes = max(1, -(-n_items // STRIPE_ROWS), -(-item_bytes // STRIPE_BYTES), busy)
    parts = min(blocks * stripes, MAX_PARTS)
    place = lambda block, stripe: (block * stripes + stripe).alias("task")
    asked = queries.select(F.lit(0).alias("side"), F.struct(*queries.columns).alias("query"), F.lit(None).cast(items.schema).alias("item"),
        _block("query_id", blocks).alias("at"), _every(stripes).alias("other")).withColumn("task", place(F.col("at"), F.col("other")))
    stored = items.select(F.lit(1).alias("side"), F.lit(None).cast(queries.schema).alias("query"), F.struct(*items.columns).alias("item"),
        _block(id_column, stripes).alias("at"), _every(blocks).alias("other")).withColumn("task", place(F.col("other"), F.col("at")))
    met = asked.unionByName(stored).select("task", "side", "query", "item")
    met = met.repartitionById(parts, F.pmod("task", F.lit(parts))).sortWithinPartitions("task", "side")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Table]]:
        for batch in batches:
            task, side = (batch.column(n).to_numpy() for n in ("task", "side"))
            cuts = [0, *(np.flatnonzero((task[1:] != task[:-1]) | (side[1:] != side[:-1])) + 1).tolist(), len(task)]
            for low, high in zip(cuts, cuts[1:]):
                if low < high:
                    rows = batch.column("item" if side[low] else "query").slice(low, high - low)
                    yield int(task[low]), int(side[low]), pa.Table.from_arrays(rows.flatten(), names=[f.name for f in rows.type])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, of_task in groupby(runs(batches), lambda run: run[0]):
            block = None
            for side, of_side in groupby(of_task, lambda run: run[1]):
                tables = (rows for _, _, rows in of_side)
                if side == 0:
                    block = pa.concat_tables(tables)
                elif block is not None:
                    for found in keeper(block).run(tables, arrow_out):
                        yield from found.to_batches()

    return met.mapInArrow(score, out)


def matches_by_cell(
    items: DataFrame, queries: DataFrame, scorer, id_column: str, k: int | None, band: tuple[float, float] | None = None
) -> DataFrame:
    """The best k items per query among those with its cell, or all in the band; ``queries`` has a row per query and cell.

    Items and queries meet on the cell. A cell with many items is split by a salt, to each part of which its queries are
    copied; its queries are split likewise, so a task holds a block of either at most.
    """
    n_queries, query_bytes = _measured(queries)
    query_blocks = max(1, -(-n_queries // BLOCK_ROWS), -(-query_bytes // BLOCK_BYTES))
    per_cell = items.groupBy("cell").agg(F.count("*").alias("_n"))
    salts = per_cell.select(F.col("cell"), F.ceil(F.col("_n") / BLOCK_ROWS).cast("int").alias("_salts"))
    columns = [id_column, *[c for c in scorer.columns if c != id_column]]
    left = items.select("cell", *columns).join(salts, "cell").withColumn("_ib", F.pmod(F.xxhash64(id_column), F.col("_salts")).cast("int"))
    left = left.drop("_salts").withColumn("_qb", _every(query_blocks))
    right = queries.join(salts, "cell").withColumn("_ib", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    right = right.drop("_salts").withColumn("_qb", _block("query_id", query_blocks))
    out = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField(id_column, items.schema[id_column].dataType),
        T.StructField("score", T.DoubleType()),
    ])

    def keeper(query_table: pa.Table) -> _Keeper:
        return _Keeper(scorer, query_table, id_column, [], k, None, band)

    found = _meet(left, right, ["cell", "_ib", "_qb"], keeper, out, to_arrow_schema(out))
    return found if k is None else _best(found, scorer, id_column, k)
