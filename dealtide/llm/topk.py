"""Exact top-k by inner product: dual-tree search over cover trees.

Levels of one cover tree, fitted on a bounded sample by farthest-first traversal, cut queries
and data into cells: few coarse ones for the queries, more for the data. A cell has a centre
and a covering radius, taken over all of its rows, so for a pair of cells
c_q.c_d + |c_q| r_d + |c_d| r_q + r_q r_d bounds every score. First each query meets its own
data cell, which gives a kth score to beat; then only pairs of cells whose bound reaches the
worst kth score of the query cell are compared, and within them smaller trees prune in the
same way. Large cells are dealt out in blocks, so that no task holds more than a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealtide.llm.common import fold, sampled, small_batches, table

# Vectors that the centres are taken from, and cells, at most; rows of a block of data and of queries.
SAMPLE, CELLS, BLOCK, QUERIES = 4096, 128, 4096, 1024
# Results of a query, the scale of components, the ids that are queries.
K, SCALE, EVERY = 10, 1024, 100
_LEAF, _FAN = 128, 8


def integral(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as doubles, which hold such integers exactly."""
    return F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))


def usable(embedding: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True))


def farthest_first(points: np.ndarray, count: int) -> np.ndarray:
    """Places of ``count`` points at most, each the farthest from those before: levels of a cover tree in order."""
    if not len(points):
        return np.zeros(0, int)
    chosen = [0]
    gap = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the distance."""
    square = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    cell = square.argmin(1)
    return cell, np.sqrt(((points - centres[cell]) ** 2).sum(1))


class Node:
    """Some rows of a block, with centre, covering radius and children."""

    def __init__(self, points: np.ndarray, rows: np.ndarray) -> None:
        own = points[rows]
        self.rows, self.centre = rows, own[0]
        self.radius = float(np.sqrt(((own - self.centre) ** 2).sum(1).max()))
        self.children: list[Node] = []
        if len(rows) > _LEAF and self.radius > 0:
            cell, _ = nearest(own, own[farthest_first(own, _FAN)])
            self.children = [Node(points, rows[cell == c]) for c in np.unique(cell)]


def bound(a: np.ndarray, ra: float, b: np.ndarray, rb: float) -> float:
    """No score between two balls is greater; a little slack covers rounding."""
    top = a @ b + np.linalg.norm(a) * rb + np.linalg.norm(b) * ra + ra * rb
    return float(top + 1e-9 * abs(top) + 1e-6)


def dual_search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int, worst: np.ndarray) -> pd.DataFrame:
    """The best ``k`` of a block for each query; pairs that cannot reach ``worst`` or better ones may be missing."""
    best = np.tile(worst[:, None], (1, 1))
    held = [(np.zeros(0), np.zeros(0, np.int64)) for _ in query_ids]
    stack = [(Node(queries, np.arange(len(queries))), Node(data, np.arange(len(data))))]
    while stack:
        q, d = stack.pop()
        if bound(q.centre, q.radius, d.centre, d.radius) < best[q.rows].min():
            continue
        if d.children or q.children:
            pairs = [(x, y) for x in (q.children or [q]) for y in (d.children or [d])]
            stack += sorted(pairs, key=lambda p: bound(p[0].centre, p[0].radius, p[1].centre, p[1].radius))
            continue
        scores = queries[q.rows] @ data[d.rows].T
        for row, found in zip(q.rows, scores, strict=True):
            some = np.flatnonzero((found >= best[row, 0]) & (ids[d.rows] != query_ids[row]))
            if not len(some):
                continue
            s, i = np.concatenate([held[row][0], found[some]]), np.concatenate([held[row][1], ids[d.rows][some]])
            order = np.lexsort((i, -s))[:k]
            held[row] = (s[order], i[order])
            if len(order) == k:
                best[row, 0] = max(best[row, 0], s[order][-1])
    sizes = [len(h[0]) for h in held]
    return pd.DataFrame({
        "query_id": np.repeat(query_ids, sizes),
        "vec_id": np.concatenate([h[1] for h in held]) if held else [],
        "score": np.concatenate([h[0] for h in held]) if held else [],
    }).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def compared(data: DataFrame, queries: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) candidates from the pairs (query_cell, cell) of cells, block by block.

    ``data`` has cell, block; ``queries`` query_cell, query_block and worst, the score to reach.
    """
    asked = queries.join(F.broadcast(pairs), "query_cell").join(
        F.broadcast(data.select("cell", "block").distinct()), "cell"
    )
    met = pairs.join(F.broadcast(queries.select("query_cell", "query_block").distinct()), "query_cell")
    offered = data.join(F.broadcast(met), "cell")
    columns = ["cell", "block", "query_cell", "query_block", "vec_id", "v", "worst"]
    both = asked.select(*columns).withColumn("asks", F.lit(True)).unionByName(
        offered.withColumn("worst", F.lit(0.0)).select(*columns).withColumn("asks", F.lit(False))
    )

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        width = max(map(len, rows.v))
        v = np.stack([np.pad(np.asarray(x, float), (0, width - len(x))) for x in rows.v])
        asks, ids = rows.asks.to_numpy(bool), rows.vec_id.to_numpy(np.int64)
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        return dual_search(v[asks], ids[asks], v[~asks], ids[~asks], k, rows.worst.to_numpy(float)[asks])

    return both.groupBy("cell", "block", "query_cell", "query_block").applyInPandas(search, "query_id long, vec_id long, score double")


def ranked(candidates: DataFrame, k: int) -> DataFrame:
    """The first ``k`` per query; Spark keeps ``k`` of each task before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score (long) of the ``k`` best rows other than the query's own.

    ``vectors`` has vec_id and v (array<double> of integers). Rows with a null id or vector take no
    part; shorter vectors count as padded with zeros. Ties go to the smaller id. A query with fewer
    than ``k`` candidates gets all of them; repeated rows are candidates of their own except for
    the query with the same id. Other columns are ignored. Without queries there are no rows. Scores
    are exact up to 2^53.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select("vec_id", "v", F.coalesce(is_query, F.lit(False)).alias("asks")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = fold(rows, "vectors")
    count, asking, width = rows.agg(F.count("*"), F.count_if("asks"), F.max(F.size("v"))).first()
    sample = [r.v for r in sampled(rows.select("vec_id", "v"), "vec_id", SAMPLE).orderBy("vec_id").collect()]
    points = np.array([list(v) + [0.0] * (width - len(v)) for v in sample]).reshape(len(sample), width or 0)
    tops = points[farthest_first(points, min(CELLS, max(1, math.ceil(count / block))))]
    if not len(tops):
        tops = np.zeros((1, width or 0))
    coarse = tops[: min(len(tops), max(1, math.ceil((asking or 0) / query_block)))]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.array([x + [0.0] * (width - len(x)) for x in batch.column("v").to_pylist()]).reshape(batch.num_rows, width)
            cell, gap = nearest(v, tops)
            query_cell, query_gap = nearest(v, coarse)
            arrays = [pa.array(a) for a in (cell, gap, query_cell, query_gap)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=["vec_id", "v", "asks", "cell", "gap", "query_cell", "query_gap"])

    shape = "vec_id long, v array<double>, asks boolean, cell long, gap double, query_cell long, query_gap double"
    placed = fold(rows.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(assign, shape), "cells")
    # one row per cell, of which there are at most CELLS
    cells = {r.cell: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("r")).collect()}
    groups = {r.query_cell: r for r in placed.where("asks").groupBy("query_cell").agg(F.count("*").alias("n"), F.max("query_gap").alias("r")).collect()}

    def dealt(column: str, found: dict, size: int, name: str, df: DataFrame) -> DataFrame:
        parts = F.lit(1)
        for c, r in found.items():
            if r.n > size:
                parts = F.when(F.col(column) == c, math.ceil(r.n / size)).otherwise(parts)
        return df.withColumn(name, F.pmod(F.xxhash64("vec_id", F.lit(name)), parts).cast("long"))

    data = dealt("cell", cells, block, "block", placed).select("cell", "block", "vec_id", "v")
    queries = dealt("query_cell", groups, query_block, "query_block", placed.where("asks"))
    # first the own cell of each query: a query cell here is the data cell
    own = dealt("own", cells, query_block, "query_block", placed.where("asks").withColumn("own", F.col("cell")))
    own = own.select(F.col("own").alias("query_cell"), "query_block", "vec_id", "v").withColumn("worst", F.lit(float("-inf")))
    same = spark.createDataFrame([(c, c) for c in cells] or [(0, 0)], "query_cell long, cell long")
    first = ranked(compared(data, own, same, k), k)
    # a query whose own cell holds fewer than k others has no score to beat
    reach = fold(first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("worst")), "reach")
    queries = queries.join(reach, "vec_id", "left").withColumn("worst", F.coalesce("worst", F.lit(float("-inf"))))
    queries = fold(queries.select("query_cell", "query_block", "vec_id", "v", "worst"), "queries")
    worst = {r.query_cell: r.w for r in queries.groupBy("query_cell").agg(F.min("worst").alias("w")).collect()}
    kept = [
        (q, c)
        for q, g in groups.items()
        for c, d in cells.items()
        if bound(coarse[q], g.r, tops[c], d.r) >= worst.get(q, float("-inf"))
    ]
    pairs = spark.createDataFrame(kept or [(-1, -1)], "query_cell long, cell long")
    found = ranked(compared(data, queries, pairs, k), k)
    return found.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(usable(F.col("embedding")))
    return search(rows.select("vec_id", integral(F.col("embedding")).alias("v")), F.col("vec_id") % EVERY == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
