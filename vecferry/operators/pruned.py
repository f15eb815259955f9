"""Exact search that skips what cannot hold a result.

Vectors lie in cells, each with a centre, a number of vectors and a radius, the largest distance of one of them from the
centre. By the triangle inequality no vector of a cell is nearer to a query than the centre's distance less the radius,
nor farther than their sum. A range search leaves out cells outside its band. A nearest-neighbour search scores the
nearest cells first; the k-th distance found there is a bound, and cells beyond it are left out. What is left is scored
exactly, so the results are those of the brute-force search, ties included. Cosine similarity is searched by the
distances of unit vectors; vectors without a direction lie in a cell of their own, which every query visits.

How much is skipped depends on the vectors: much where they lie in clusters, next to nothing where they are spread evenly
in many dimensions. ``skipped`` tells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecferry.operators.ann import CellIndex, build_cells, probe
from vecferry.operators.scoring import DIGITS, Dense, matches, matches_by_cell
from vecferry.session import written

PLACE = "_place"  # where a vector lies: itself, or its direction
EVERYWHERE = -1  # cell of what has no place
SLACK = 4 * 10.0**-DIGITS  # scores are rounded
FIRST_CELLS = 2


@dataclass
class BoundedCells:
    index: CellIndex
    bounds: DataFrame  # cell, n, radius; one row per cell
    metric: str
    vector: str
    id_column: str


def _length(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))


def _placed(rows: DataFrame, vector: str, metric: str) -> DataFrame:
    values = F.col(vector).cast("array<double>")
    if metric == "L2":
        return rows.withColumn(PLACE, values)
    unit = F.when(_length(values) > 0, F.transform(values, lambda x: x / _length(values)))
    return rows.withColumn(PLACE, unit)


def build_bounded_cells(
    vectors: DataFrame, path: str, n_cells: int, dim: int, metric: str = "L2", id_column: str = "id", vector: str = "vector"
) -> BoundedCells:
    """Lays the vectors out by cell and measures the cells. Vectors with a null or NaN component match nothing and are left out."""
    if metric not in ("L2", "COSINE"):
        raise ValueError("cells bound L2 distances and cosine similarities")
    whole = vectors.filter(F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)))
    placed = _placed(whole, vector, metric)
    index = build_cells(placed.filter(F.col(PLACE).isNotNull()), path, n_cells, dim, id_column, PLACE)
    if metric == "COSINE":
        placed.filter(F.col(PLACE).isNull()).withColumn("cell", F.lit(EVERYWHERE)).write.mode("append").partitionBy("cell").parquet(path)
    centres = np.array([r[PLACE] for r in index.centres.orderBy("id").collect()]).reshape(-1, dim)  # one per cell, a parameter

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
        for batch in batches:
            if batch.num_rows:
                cell = batch.column("cell").to_numpy()
                at = batch.column(PLACE).flatten().to_numpy().reshape(len(cell), -1)
                np.maximum.at(radius, cell, np.sqrt(((at - centres[cell]) ** 2).sum(axis=1)))
                n += np.bincount(cell, minlength=len(centres))
        here = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(here, pa.int32()), pa.array(n[here]), pa.array(radius[here])], names=["cell", "n", "radius"])

    stored = vectors.sparkSession.read.parquet(path)
    parts = stored.filter(F.col("cell") >= 0).select("cell", PLACE).mapInArrow(measure, "cell int, n long, radius double")
    loose = stored.filter(F.col("cell") == EVERYWHERE).groupBy("cell").agg(F.count("*").alias("n")).select("cell", "n", F.lit(float("inf")).alias("radius"))
    bounds = parts.groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).unionByName(loose)
    return BoundedCells(index, written(bounds, "cell-bounds"), metric, vector, id_column)


def _reached(cells: BoundedCells, asked: DataFrame, reach: float) -> DataFrame:
    """``query_id, cell, apart, radius`` of the cells that come within ``reach`` of a query, and of the loose one for all."""
    widest = cells.bounds.filter(F.col("cell") >= 0).agg(F.max("radius").alias("r")).first().r or 0.0
    near = matches(cells.index.centres, asked.select("query_id", PLACE), Dense("L2", PLACE), "id", band=(0.0, reach + widest + SLACK))
    near = near.select("query_id", F.col("id").cast("int").alias("cell"), F.col("score").alias("apart")).join(cells.bounds.select("cell", "radius"), "cell")
    loose = cells.bounds.filter(F.col("cell") == EVERYWHERE).select("cell", "radius")  # one row at most
    return near.select("query_id", "cell", "apart", "radius").unionByName(
        asked.select("query_id").join(F.broadcast(loose)).select("query_id", "cell", F.lit(0.0).alias("apart"), "radius"))


def _search(cells: BoundedCells, asked: DataFrame, pairs: DataFrame, k: int | None, band: tuple[float, float] | None = None) -> DataFrame:
    wanted = [r.cell for r in pairs.select("cell").distinct().collect()]  # at most as many as there are cells
    items = asked.sparkSession.read.parquet(cells.index.path).filter(F.col("cell").isin(wanted))
    met = pairs.select("query_id", "cell").join(asked.select("query_id", cells.vector), "query_id")
    return matches_by_cell(items, met, Dense(cells.metric, cells.vector), cells.id_column, k, band)


def _asked(cells: BoundedCells, queries: DataFrame) -> DataFrame:
    """Queries with their place; one without a direction has no similarity but 0 and is placed at the origin."""
    placed = _placed(queries.filter(F.col(cells.vector).isNotNull()), cells.vector, cells.metric)
    return written(placed.withColumn(PLACE, F.coalesce(PLACE, F.transform(F.col(cells.vector), lambda x: F.lit(0.0)))), "asked")


def range_pairs(cells: BoundedCells, asked: DataFrame, low: float, high: float) -> DataFrame:
    """The cells that may hold a vector with low <= distance < high."""
    near = _reached(cells, asked, high)
    return near.filter((F.col("apart") - F.col("radius") < high + SLACK) & (F.col("apart") + F.col("radius") >= low - SLACK))


def pruned_range(cells: BoundedCells, queries: DataFrame, low: float, high: float) -> DataFrame:
    """All rows with low <= L2 distance < high, as ``range_search`` finds them."""
    if cells.metric != "L2":
        raise ValueError("ranges are of L2 distances")
    asked = _asked(cells, queries)
    return _search(cells, asked, written(range_pairs(cells, asked, low, high), "cell-pairs"), None, (low, high))


def knn_pairs(cells: BoundedCells, asked: DataFrame, k: int) -> DataFrame:
    """The cells that may hold one of the k best, by the k-th best of the nearest cells."""
    first = written(probe(cells.index, asked, FIRST_CELLS, PLACE).select("query_id", "cell"), "first-cells")
    best = _search(cells, asked, first, k).groupBy("query_id").agg(F.max("rank").alias("found"), F.max_by("score", "rank").alias("worst"))
    far = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * (F.col("worst") - SLACK))) if cells.metric == "COSINE" else F.col("worst")
    bound = best.select(F.col("query_id").alias("_of"), F.when(F.col("found") == k, far).otherwise(float("inf")).alias("bound"))
    # A query without a direction is alike to everything: it visits all cells.
    plain = asked.select("query_id", (_length(F.col(PLACE)) > 0).alias("_directed"))
    bounds = written(plain.join(bound, F.col("query_id") == F.col("_of"), "left").select(
        F.col("query_id").alias("_of"),
        F.when(F.col("_directed") | F.lit(cells.metric == "L2"), F.coalesce("bound", F.lit(float("inf")))).otherwise(float("inf")).alias("bound")), "bounds")
    widest = bounds.agg(F.max("bound").alias("b")).first().b
    near = _reached(cells, asked, widest if widest is not None else 0.0)
    met = near.join(bounds, F.col("query_id") == F.col("_of"))
    return met.filter(F.col("apart") - F.col("radius") <= F.col("bound") + SLACK).select("query_id", "cell", "apart", "radius")


def pruned_knn(cells: BoundedCells, queries: DataFrame, k: int) -> DataFrame:
    """The best k per query, as ``knn`` finds them."""
    asked = _asked(cells, queries)
    return _search(cells, asked, written(knn_pairs(cells, asked, k), "cell-pairs"), k)


def skipped(cells: BoundedCells, pairs: DataFrame) -> DataFrame:
    """Per query: cells and vectors, how many of them were visited, and the share of vectors that was skipped."""
    whole = cells.bounds.agg(F.count("*").alias("n_cells"), F.sum("n").alias("n_vectors"))
    visited = pairs.select("query_id", "cell").distinct().join(cells.bounds.select("cell", "n"), "cell").groupBy("query_id").agg(
        F.count("*").alias("visited_cells"), F.sum("n").alias("visited_vectors"))
    return visited.join(F.broadcast(whole)).select(
        "query_id", "n_cells", "n_vectors", "visited_cells", "visited_vectors",
        F.round(1 - F.col("visited_vectors") / F.col("n_vectors"), 4).alias("skipped_share"))
