"""Exact top-k inner-product search with a vector-approximation file.

Vectors are integers per component. The file keeps, for blocks of vectors, a
few bits per component (the cell the value lies in) and a hash of the whole
vector. A search has two phases:

1. scan the cells: the cell bounds give every vector a lower and an upper
   bound of its score with a query (distance bounds, for inner products). In a
   block, only vectors whose upper bound reaches the k-th best lower bound
   stay; over all blocks, the k-th best lower bound of a query cuts again;
2. read exact vectors in the order of their bounds: first the best
   ``FIRST`` of each query, whose k-th exact score is a floor, then all others
   whose upper bound reaches that floor. Then the k-th result is certain.

Queries are a stated set; they are cut into blocks and every block of vectors
meets every block of queries. Within a block, of equal vectors only those of
the ``k + 1`` smallest ids, ``k`` rows of each, can be among a query's results
(the others tie and lose), so a very common vector adds few candidates.

A vector that is null, empty, of another length than most declare (``dims``),
or holds a null or non-finite component takes no part, nor does a row without
id. Rows with the same id are separate candidates except to the query of that
id: every row has a key of its own from the file to the exact vectors. A query
id that stands in several rows has the best pairs of all of them, so a
neighbour comes once for each row. Empty tables and empty query sets give no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.materialize import materialize

BITS = 6
BLOCK_ROWS = 2048
QUERY_ROWS = 512
FIRST = 4  # times k: exact vectors read before the floor is set


def integers(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component as a double; null where a component is null or not finite."""
    v = vector.cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.when(ok & (F.size(v) > 0), F.transform(v, lambda x: F.floor(x * scale).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(lists)
    return np.asarray(lists.flatten()).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _few_equal(ids: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows that can be among a query's results: of equal vectors, ``k + 1`` ids and ``k`` rows of each."""
    _, group = np.unique(v, axis=0, return_inverse=True)
    group = group.ravel()
    order = np.lexsort((ids, group))
    g, i = group[order], ids[order]
    first = np.r_[True, g[1:] != g[:-1]]
    start = first | np.r_[True, i[1:] != i[:-1]]
    at = np.arange(len(g))
    copy = at - np.maximum.accumulate(np.where(start, at, 0))
    nth = np.cumsum(start)  # number of the id, over all groups
    nth = nth - np.maximum.accumulate(np.where(first, nth, 0))
    return np.sort(order[(nth <= k) & (copy < k)])


def _blocks(batches, marks: np.ndarray, k: int, block_rows: int) -> Iterator[pa.RecordBatch]:
    """(row, vec_id, v) in; one row per block of approximations out."""
    names = ["rows", "ids", "cells"]
    buffer_rows, buffer_ids, buffer_v = [], [], []

    def made(rows, ids, v):
        order = np.lexsort((ids, *v.T[:2]))
        rows, ids, v = rows[order], ids[order], v[order]
        keep = _few_equal(ids, v, k)
        rows, ids, v = rows[keep], ids[keep], v[keep]
        cells = np.stack([np.searchsorted(marks[d], v[:, d], side="right") - 1 for d in range(v.shape[1])], axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows.astype("<i8").tobytes()]), pa.array([ids.astype("<i8").tobytes()]),
             pa.array([cells.astype(np.uint8).tobytes()])], names=names)

    held = 0
    for batch in batches:
        buffer_rows.append(batch.column(0).to_numpy(zero_copy_only=False))
        buffer_ids.append(batch.column(1).to_numpy(zero_copy_only=False))
        buffer_v.append(_matrix(batch.column(2)))
        held += len(buffer_ids[-1])
        while held >= block_rows:
            rows, ids, v = np.concatenate(buffer_rows), np.concatenate(buffer_ids), np.concatenate(buffer_v)
            yield made(rows[:block_rows], ids[:block_rows], v[:block_rows])
            buffer_rows, buffer_ids, buffer_v = [rows[block_rows:]], [ids[block_rows:]], [v[block_rows:]]
            held = len(buffer_ids[0])
    if held:
        yield made(np.concatenate(buffer_rows), np.concatenate(buffer_ids), np.concatenate(buffer_v))


def _query_blocks(batches, rows: int) -> Iterator[pa.RecordBatch]:
    """(query, query_id, v) in; blocks of at most ``rows`` queries out."""
    for batch in batches:
        keys, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        v = _matrix(batch.column(2))
        for at in range(0, len(ids), rows):
            part = (keys[at : at + rows], ids[at : at + rows], v[at : at + rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.astype("<i8").tobytes()]) for x in part], names=["query_rows", "query_ids", "queries"])


def _bounds(batches, marks: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """A block of approximations beside a block of queries in; candidates with their bounds out."""
    dims = len(marks)
    at = np.arange(dims)
    for batch in batches:
        for rows, ids, cells, qrows, qids, queries in zip(*(batch.column(i).to_pylist() for i in range(6))):
            rows, ids, qrows, qids = (np.frombuffer(x, "<i8") for x in (rows, ids, qrows, qids))
            cells = np.frombuffer(cells, np.uint8).reshape(-1, dims)
            q = np.frombuffer(queries, "<i8").reshape(-1, dims).astype(np.float64)
            low, high = marks[at, cells].astype(np.float64), marks[at, cells + 1] - 1.0
            pos, neg = np.maximum(q, 0), np.minimum(q, 0)
            lower = pos @ low.T + neg @ high.T  # whole numbers below 2**53: exact
            upper = pos @ high.T + neg @ low.T
            own = qids[:, None] == ids[None, :]
            lower[own] = upper[own] = -np.inf
            if lower.shape[1] > k:
                floor = np.partition(lower, -k, axis=1)[:, -k]
            else:
                floor = np.full(len(q), -np.inf)
            i, j = np.nonzero((upper >= floor[:, None]) & (upper > -np.inf))
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qrows[i]), pa.array(rows[j]), pa.array(lower[i, j].astype(np.int64)),
                     pa.array(upper[i, j].astype(np.int64))],
                    names=["query", "row", "lower", "upper"])


def _kth(df: DataFrame, by: str, k: int, name: str) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.col(by).desc())
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).groupBy("query").agg(
        F.min(F.when(F.col("_n") == k, F.col(by))).alias(name))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, bits: int = BITS, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """The ``k`` best other rows of every query: query_id, rank (from 1), vec_id, score. Ties go to the smaller id."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), is_query.alias("is_query"),
                         integers(F.col(vector_col), scale).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    dims = [r[0] for r in src.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()]
    out = "query_id long, rank int, vec_id long, score long"
    if not dims:
        return vectors.sparkSession.createDataFrame([], out)
    src = materialize(src.where(F.size("v") == dims[0]).withColumn("row", F.monotonically_increasing_id()))  # written: the keys stay
    lo, hi = [], []
    edges = src.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x"), F.max("x")).collect()
    for _, a, b in sorted(edges):  # one row per dimension
        lo.append(a)
        hi.append(b)
    cells = 1 << bits
    marks = np.stack([  # cell c of a dimension holds the whole numbers from marks[c] to marks[c + 1] - 1
        a + (np.arange(cells + 1) * max(cells, b + 1 - a)) // cells for a, b in zip(lo, hi)]).astype(np.int64)

    # equal rows of a query id are one query, whose pairs count as often as it stands there
    queries = src.where("is_query").groupBy(F.col("vec_id").alias("query_id"), "v").agg(
        F.min("row").alias("query"), F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("times"))
    queries = materialize(queries)
    qblocks = materialize(queries.select("query", "query_id", "v").mapInArrow(
        lambda it: _query_blocks(it, QUERY_ROWS), "query_rows binary, query_ids binary, queries binary").withColumn(
        "qb", F.monotonically_increasing_id()))
    numbered = [r[0] for r in qblocks.select("qb").collect()]  # one number for each block of queries
    if not numbered:
        return vectors.sparkSession.createDataFrame([], out)
    approx = materialize(src.select("row", "vec_id", "v").mapInArrow(
        lambda it: _blocks(it, marks, k, BLOCK_ROWS), "rows binary, ids binary, cells binary"))
    met = approx.withColumn("qb", F.explode(F.array(*[F.lit(x) for x in numbered]))).join(qblocks, "qb")
    cand = materialize(met.select("rows", "ids", "cells", "query_rows", "query_ids", "queries").mapInArrow(
        lambda it: _bounds(it, marks, k), "query long, row long, lower long, upper long"))
    floor = _kth(cand, "lower", k, "floor")
    cand = cand.join(floor, "query").where("floor IS NULL OR upper >= floor").select("query", "row", "upper")
    order = Window.partitionBy("query").orderBy(F.col("upper").desc(), "row")
    cand = materialize(cand.withColumn("_n", F.row_number().over(order)))

    def exact(c: DataFrame) -> DataFrame:
        q = queries.select("query", "query_id", "times", F.col("v").alias("_q"))
        j = c.join(src.select("row", "vec_id", "v"), "row").join(q, "query")
        dot = F.aggregate(F.zip_with("v", "_q", lambda a, b: a * b), F.lit(0).cast("long"), lambda acc, x: acc + x)
        return j.select("query", "query_id", "times", "vec_id", dot.alias("score"))

    first = materialize(exact(cand.where(F.col("_n") <= FIRST * k)))
    sure = _kth(first, "score", k, "sure")
    rest = exact(cand.where(F.col("_n") > FIRST * k).join(sure, "query").where("sure IS NULL OR upper >= sure"))
    every = first.union(rest).select(
        "query_id", "vec_id", "score", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("_time"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
