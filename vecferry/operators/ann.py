"""Approximate search as data work: coarse cells with probing, 8-bit codes, product codes, recall.

Centres come from k-means over every vector: the start is the vectors of lowest id digest, a round is one pass that sums
the vectors of each centre, and centres are rounded. So the result depends on the table alone, not on its layout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecferry.functions import vectors as ve
from vecferry.operators.scoring import Dense, matches, matches_by_cell
from vecferry.operators.search import knn
from vecferry.session import written
from vecferry.sources.target import balanced

ROUNDS = 6
DIGITS = 6
STEP = 4096  # rows that one step of an assignment works on


def slices(dim: int, parts: int) -> list[tuple[int, int]]:
    """First value and width of each part; the first ``dim % parts`` parts have one value more."""
    width, more = divmod(dim, parts)
    widths = [width + (p < more) for p in range(parts)]
    return [(sum(widths[:p]), widths[p]) for p in range(parts)]


def _matrix(batch: pa.RecordBatch, vector: str) -> np.ndarray:
    column = batch.column(vector)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest_centres(rows: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """(row, part) -> nearest centre of the part; ties go to the lower centre."""
    out = np.empty((len(rows), len(books)), np.int32)
    at = 0
    for part, book in enumerate(books):
        width = book.shape[1]
        for start in range(0, len(rows), STEP):
            piece = rows[start : start + STEP, at : at + width]
            far = ((piece[:, None, :] - book[None]) ** 2).sum(axis=2) if width * len(book) <= 4096 else (
                (piece**2).sum(axis=1)[:, None] + (book**2).sum(axis=1)[None] - 2 * piece @ book.T)
            out[start : start + STEP, part] = far.argmin(axis=1)
        at += width
    return out


def fit_centres(vectors: DataFrame, dim: int, parts: int, centres: int, id_column: str = "id", vector: str = "vector", rounds: int = ROUNDS) -> list[np.ndarray]:
    """k-means for each slice of the vectors, over all of them; (centre, value) per part.

    What reaches the driver is the centres themselves: ``centres`` vectors at the start and their sums in each round.
    A centre to which no vector goes stays where it is.
    """
    present = vectors.filter(F.col(vector).isNotNull()).select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    start = present.orderBy(F.md5(F.col("id").cast("string").cast("binary")), "id").limit(centres).collect()
    whole = np.array([r.v for r in start]).reshape(len(start), -1)
    if len(start) and whole.shape[1] != dim:
        raise ValueError(f"vectors have {whole.shape[1]} dimensions, not {dim}")
    books = [whole[:, at : at + width].copy() if len(start) else np.zeros((0, width)) for at, width in slices(dim, parts)]
    if not len(start):
        return books

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros_like(book) for book in books]
        count = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch, "v")
                near, at = nearest_centres(rows, books), 0
                for part, book in enumerate(books):
                    np.add.at(total[part], near[:, part], rows[:, at : at + book.shape[1]])
                    count[part] += np.bincount(near[:, part], minlength=len(book))
                    at += book.shape[1]
        keys = [(part, c) for part in range(len(books)) for c in np.flatnonzero(count[part]).tolist()]
        yield pa.RecordBatch.from_arrays([
            pa.array([p for p, _ in keys], pa.int32()), pa.array([c for _, c in keys], pa.int32()),
            pa.array([int(count[p][c]) for p, c in keys], pa.int64()), pa.array([total[p][c].tolist() for p, c in keys], pa.list_(pa.float64())),
        ], names=["part", "centre", "n", "total"])

    for _ in range(rounds):
        found = present.select("v").mapInArrow(sums, "part int, centre int, n long, total array<double>")
        mean = vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total")
        for r in found.groupBy("part", "centre").agg(F.sum("n").alias("n"), mean).collect():  # at most parts x centres rows
            books[r.part][r.centre] = np.round(np.array(r.total) / r.n, DIGITS)
    return books


def assigned(vectors: DataFrame, books: list[np.ndarray], vector: str = "vector", codes: str = "codes") -> DataFrame:
    """Adds the nearest centre of every slice in one Arrow pass; null for a null vector."""

    @F.arrow_udf("array<int>")
    def code(column: pa.Array) -> pa.Array:
        present = column.is_valid().to_numpy(zero_copy_only=False)
        rows = column.drop_null()
        near = nearest_centres(rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1), books) if len(rows) else np.zeros((0, len(books)), np.int32)
        offsets = np.concatenate([[0], np.cumsum(present * len(books))]).astype(np.int32)
        whole = pa.ListArray.from_arrays(pa.array(offsets), pa.array(near.ravel()))
        return pc.if_else(pa.array(present), whole, pa.scalar(None, whole.type))

    return vectors.withColumn(codes, code(F.col(vector).cast("array<double>")))


@dataclass
class CellIndex:
    path: str
    centres: DataFrame  # id, vector; one row per cell


def build_cells(vectors: DataFrame, path: str, n_cells: int, dim: int, id_column: str = "id", vector: str = "vector") -> CellIndex:
    """Every vector goes to its nearest centre; the table is laid out by cell, big cells over several files."""
    present = vectors.filter(F.col(vector).isNotNull())
    books = fit_centres(present, dim, 1, n_cells, id_column, vector)
    placed = assigned(present, books, vector, "_cells").withColumn("cell", F.col("_cells")[0]).drop("_cells")
    balanced(placed, "cell").write.partitionBy("cell").parquet(path)
    rows = pa.table({"id": list(range(len(books[0]))), vector: [c.tolist() for c in books[0]]})
    schema = f"id long, {vector} array<double>"
    return CellIndex(path, vectors.sparkSession.createDataFrame(rows, schema))


def probe(index: CellIndex, queries: DataFrame, n_probe: int, vector: str = "vector") -> DataFrame:
    """One row per query and each of its nearest cells."""
    nearest = knn(index.centres, queries, n_probe, "L2", "id", vector)
    return queries.join(nearest.select("query_id", F.col("id").cast("int").alias("cell")), "query_id")


def ann_search(
    index: CellIndex, queries: DataFrame, k: int, n_probe: int, metric: str = "COSINE", id_column: str = "id", vector: str = "vector"
) -> DataFrame:
    """Best k among the probed cells; items meet only the queries that probe their cell.

    The probes are written once: how many cells each query probes is a parameter, so they are as few as the queries.
    Cells that no query probes are not read.
    """
    spark = queries.sparkSession
    probed = written(probe(index, queries, n_probe, vector), "probed")
    wanted = [r.cell for r in probed.select("cell").distinct().collect()]  # at most as many as there are cells
    items = spark.read.parquet(index.path).filter(F.col("cell").isin(wanted))
    return matches_by_cell(items, probed, Dense(metric, vector), id_column, k)


def recall_at_k(found: DataFrame, exact: DataFrame, id_column: str = "id") -> DataFrame:
    """Share of the exact results that the approximate search found, per query."""
    hits = found.select("query_id", id_column, F.lit(1).alias("_hit"))
    return exact.join(hits, ["query_id", id_column], "left").groupBy("query_id").agg(
        F.count("*").alias("n_exact"), F.count("_hit").alias("n_found"),
        F.round(F.count("_hit") / F.count("*"), 4).alias("recall"),
    )


def value_ranges(vectors: DataFrame, vector: str) -> DataFrame:
    """Lowest and highest value per dimension, one row."""
    features = array_to_vector(F.col(vector).cast("array<double>"))
    summary = vectors.filter(F.col(vector).isNotNull()).agg(Summarizer.metrics("min", "max").summary(features).alias("s"))
    return summary.select(vector_to_array("s.min").alias("low"), vector_to_array("s.max").alias("high"))


def quantize_sq8(vectors: DataFrame, vector: str = "vector", code: str = "code") -> DataFrame:
    """One code 0..255 per dimension, between its lowest and highest value over all rows."""
    ranges = value_ranges(vectors, vector)
    ranged = vectors.withColumn("_low", ranges.select("low").scalar()).withColumn("_high", ranges.select("high").scalar())

    def level(x: Column, i: Column) -> Column:
        low, high = F.get("_low", i), F.get("_high", i)
        share = F.try_divide(x.cast("double") - low, high - low)
        return F.coalesce(F.floor(share * 255 + 0.5), F.lit(0)).cast("smallint")

    return ranged.withColumn(code, F.transform(vector, level)).drop("_low", "_high")


class ProductCodes(Dense):
    """Scores of product codes from per-query tables: L2, or inner product for the other metrics."""

    def __init__(self, metric: str, books: list[np.ndarray], column: str = "codes"):
        super().__init__(metric, column)
        self.books = books  # per part (centre, value)

    def prepare(self, queries: pa.Table) -> list[np.ndarray]:
        asked, at, tables = np.stack(queries.column("vector").to_pylist()).astype(np.float64), 0, []
        for book in self.books:
            part = asked[:, None, at : at + book.shape[1]]
            tables.append(((part - book[None]) ** 2).sum(axis=2) if self.metric == "L2" else (part * book[None]).sum(axis=2))
            at += book.shape[1]
        return tables

    def score(self, tables: list[np.ndarray], rows: pa.Table) -> np.ndarray:
        codes = self._matrix(rows).astype(np.int64)
        total = sum(table[:, codes[:, part]] for part, table in enumerate(tables)).T
        return np.sqrt(total) if self.metric == "L2" else total


def quantize_pq(vectors: DataFrame, books: list[np.ndarray], vector: str = "vector", codes: str = "codes") -> DataFrame:
    """Nearest centre of every slice; null for a null vector."""
    return assigned(vectors, books, vector, codes)


def pq_search(
    coded: DataFrame, queries: DataFrame, books: list[np.ndarray], k: int, metric: str = "IP", id_column: str = "id",
    refine: int = 1, vector: str = "vector",
) -> DataFrame:
    """Best k by product codes. With ``refine`` above 1 the best ``refine * k`` by codes are ranked by exact score.

    Those candidates alone are joined with their vectors, ``refine * k`` rows per query.
    """
    found = matches(coded, queries, ProductCodes(metric, books), id_column, k=k * refine)
    if refine == 1:
        return found
    asked = queries.select("query_id", F.col("vector").alias("_q"))
    rows = found.select("query_id", id_column).join(coded.select(id_column, F.col(vector).alias("_v")), id_column).join(asked, "query_id")
    exact = {"L2": ve.l2_distance, "COSINE": ve.cosine}.get(metric, ve.dot)(F.col("_v"), F.col("_q"))
    scored = rows.select("query_id", id_column, F.round(exact, DIGITS).alias("score"))
    best = F.col("score").asc() if metric == "L2" else F.col("score").desc()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(best, F.col(id_column).asc()))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)
