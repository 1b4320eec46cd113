"""Hard-negative mining with Kronecker-packed products.

Vectors are whole numbers per component. A shift makes every component
non-negative, and ``fields`` candidates are packed into one wide integer per
component: candidate ``f`` stands ``f * width`` bits up. An anchor multiplies
each packed component once; the products add up field by field and no field
can overflow into the next, because ``width`` holds ``dims * span**2``. The
scores of all packed candidates are then read out by shifts and masks, and the
shift of the components is taken back exactly:
``a.c = field - s*sum(c) - s*sum(a) - dims*s*s``.

The wide integers are doubles as long as ``fields`` of them fit into the 53
bits that a double holds exactly (every partial sum is a whole number below
2**53, so the matrix product is exact in any order); components too large for
that are packed into Python integers of any width.

Two passes over the packed file: the first finds every anchor's positives (its
best rows of the same label), the second, for each anchor and positive, the
best rows of another label whose score lies between ``low`` and ``high``
percent of the positive's. Anchors are a stated set: they are numbered, cut
into passes of ``PASS_ANCHORS`` and sent to the tasks pass by pass, so what a
task holds does not grow with the table. A task keeps only the best rows of
each anchor over all its blocks.

A row without id or label, or with a vector that is null, empty, holds a null
or non-finite component, or has another length than most, takes no part. Rows
are told apart by a key of their own: a repeated row is a candidate of its
own, and a repeated anchor row is an anchor of its own. Empty tables and
anchor sets give no rows; other columns of the table are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.running import number_rows
from cadastra.llm.vafile import _matrix, integers
from cadastra.operators.materialize import materialize

BLOCK_ROWS = 2048
PASS_ANCHORS = 4096
ANCHOR_ROWS = 512  # anchors multiplied at once in a task
SALTS = 16  # first ranking of an anchor's candidates is split so
NONE = np.iinfo(np.int64).min
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Packing:
    """How many candidates share a wide integer, and how scores are read out of the products."""

    def __init__(self, dims: int, low: int, high: int):
        self.dims, self.shift = dims, -low
        self.width = (dims * (high - low) ** 2).bit_length()
        self.exact_doubles = 2 * self.width <= 53
        self.fields = 53 // self.width if self.exact_doubles else 8
        self.dtype = np.float64 if self.exact_doubles else object

    def pack(self, v: np.ndarray) -> np.ndarray:
        """(rows, dims) whole numbers to (ceil(rows / fields), dims) wide integers."""
        c = (v.astype(object) if self.dtype is object else v) + self.shift
        rest = -len(c) % self.fields
        if rest:
            c = np.concatenate([c, np.zeros((rest, self.dims), c.dtype)])
        packed = np.zeros((len(c) // self.fields, self.dims), c.dtype)
        for f in range(self.fields):
            packed = packed + (c[f :: self.fields] << (f * self.width))
        return packed.astype(self.dtype)

    def scores(self, anchors: np.ndarray, packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Exact inner products, (anchors, rows), from one multiplication per packed component."""
        whole = np.int64 if self.exact_doubles else object
        products = ((anchors.astype(whole) + self.shift).astype(self.dtype) @ packed.T).astype(whole)
        out = np.empty((len(anchors), packed.shape[0] * self.fields), whole)
        mask = (1 << self.width) - 1
        for f in range(self.fields):
            out[:, f :: self.fields] = (products >> (f * self.width)) & mask
        out = out[:, : len(sums)]
        own = anchors.astype(whole).sum(axis=1)
        return (out - self.shift * sums.astype(whole)[None, :] - (self.shift * own)[:, None]
                - self.dims * self.shift * self.shift).astype(np.int64)


def _pack_blocks(batches, packing: Packing):
    """(row, vec_id, label, v) in; blocks of packed candidates out, ordered by id inside."""
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
        v = _matrix(batch.column(3))
        order = np.lexsort((cols[0], cols[1]))
        for at in range(0, len(order), BLOCK_ROWS):
            part = order[at : at + BLOCK_ROWS]
            wide = packing.pack(v[part])
            if packing.exact_doubles:
                body = wide.astype("<f8").tobytes()
            else:
                size = (packing.width * packing.fields + 7) // 8
                body = b"".join(int(x).to_bytes(size, "little") for x in wide.ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.astype("<i8").tobytes()]) for x in (*(c[part] for c in cols), v[part].sum(axis=1))]
                + [pa.array([body])], names=["rows", "ids", "labels", "sums", "packed"])


def _unpack_block(block, packing: Packing):
    rows, ids, labels, sums = (np.frombuffer(x, "<i8") for x in block[:4])
    if packing.exact_doubles:
        wide = np.frombuffer(block[4], "<f8").reshape(-1, packing.dims)
    else:
        size = (packing.width * packing.fields + 7) // 8
        wide = np.array([int.from_bytes(block[4][i : i + size], "little") for i in range(0, len(block[4]), size)],
                        object).reshape(-1, packing.dims)
    return rows, ids, labels, sums, wide


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """The ``k`` largest scores of each line, ties by smaller id, then row; ``NONE`` is no candidate."""
    ids, rows = (np.broadcast_to(x, scores.shape) for x in (ids, rows))
    if scores.shape[1] > 4 * k:  # only lines' k-th scores and what ties with them are sorted
        floor = np.partition(scores, -k, axis=1)[:, -k]
        i, j = np.nonzero((scores >= floor[:, None]) & (scores > NONE))
    else:
        i, j = np.nonzero(scores > NONE)
    s, a, r = scores[i, j], ids[i, j], rows[i, j]
    order = np.lexsort((r, a, -s, i))
    i, s, a, r = i[order], s[order], a[order], r[order]
    first = np.searchsorted(i, np.arange(len(scores)))
    nth = np.arange(len(i)) - first[i]
    keep = nth < k
    out = [np.full((len(scores), k), NONE), np.zeros((len(scores), k), np.int64), np.zeros((len(scores), k), np.int64)]
    for x, values in zip(out, (s, a, r)):
        x[i[keep], nth[keep]] = values[keep]
    return out


def _search(batches, shared, packing: Packing, k: int, band: tuple[int, int] | None):
    """Packed blocks in; per line its ``k`` best candidates of this task out.

    Without ``band`` a line is an anchor and candidates are the other rows of
    its label; with it, a line is an (anchor, positive) pair and candidates are
    the rows of other labels whose score is in the band.
    """
    lines = shared.value  # anchor position, key, label, [positive score] by line; anchor vectors
    held = None
    for batch in batches:
        for block in zip(*(batch.column(i).to_pylist() for i in range(5))):
            rows, ids, labels, sums, wide = _unpack_block(block, packing)
            if held is None:
                held = [np.full((len(lines["key"]), k), NONE)] + [np.zeros((len(lines["key"]), k), np.int64)] * 2
                held = [x.copy() for x in held]
            for at in range(0, len(lines["vectors"]), ANCHOR_ROWS):
                scores = packing.scores(lines["vectors"][at : at + ANCHOR_ROWS], wide, sums)
                mine = np.nonzero((lines["anchor"] >= at) & (lines["anchor"] < at + ANCHOR_ROWS))[0]
                s = scores[lines["anchor"][mine] - at]
                same = lines["label"][mine][:, None] == labels[None, :]
                if band is None:
                    ok = same & (lines["key"][mine][:, None] != rows[None, :])
                else:
                    p = lines["positive_score"][mine][:, None]
                    ok = ~same & (band[0] * p <= 100 * s) & (100 * s <= band[1] * p)
                found = best(np.where(ok, s, NONE), ids, rows, k)
                merged = [np.concatenate([h[mine], f], axis=1) for h, f in zip(held, found)]
                for h, m in zip(held, best(merged[0], merged[1], merged[2], k)):
                    h[mine] = m
    if held is not None:
        i, j = np.nonzero(held[0] > NONE)
        for at in range(0, len(i), 50_000):
            x, y = i[at : at + 50_000], j[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines["line"][x]), pa.array(held[0][x, y]), pa.array(held[1][x, y]), pa.array(held[2][x, y])],
                names=["line", "score", "vec_id", "row"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best candidates of a line over all tasks; ranked in two steps, so no task gets all of a line's."""
    order = [F.col("score").desc(), F.col("vec_id"), F.col("row")]
    salted = Window.partitionBy("line", "_salt").orderBy(*order)
    some = found.withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS))).withColumn(
        "_n", F.row_number().over(salted)).where(F.col("_n") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("line").orderBy(*order))).where(
        F.col("rank") <= k).drop("_salt", "_n")


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, id_col: str = "vec_id", vector_col: str = "embedding",
         scale: int = 256) -> DataFrame:
    """For each anchor and positive its hard negatives: anchor_id, positive_id, rank, negative_id, both scores.

    ``is_anchor`` and ``label`` are expressions over the columns of ``vectors``;
    ``label`` must be a whole number.
    """
    spark = vectors.sparkSession
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                         is_anchor.alias("is_anchor"), integers(F.col(vector_col), scale).alias("v")).where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    dims = [r[0] for r in src.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()]
    if not dims:
        return spark.createDataFrame([], OUT)
    src = materialize(src.where(F.size("v") == dims[0]).withColumn("row", F.monotonically_increasing_id()))
    least, most = src.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    packing = Packing(dims[0], least, most + 1)
    anchors = materialize(number_rows(src.where("is_anchor").select("row", "vec_id", "label", "v"), [F.col("row")], "_number")
                          .withColumn("_pass", F.floor(F.col("_number") / PASS_ANCHORS)))
    passes = anchors.agg(F.max("_pass")).first()[0]
    if passes is None:
        return spark.createDataFrame([], OUT)
    file = materialize(src.select("row", "vec_id", "label", "v").mapInArrow(
        lambda it: _pack_blocks(it, packing), "rows binary, ids binary, labels binary, sums binary, packed binary"))
    found_schema = "line long, score long, vec_id long, row long"
    out = None
    for p in range(passes + 1):  # at most PASS_ANCHORS rows of each pass leave the cluster
        held = anchors.where(F.col("_pass") == p).select("row", "vec_id", "label", "v").orderBy("row").toArrow()
        key, ids, labels = (held.column(i).to_numpy() for i in range(3))
        matrix = _matrix(held.column(3))
        at = np.arange(len(key))
        lines = spark.sparkContext.broadcast({"line": key, "anchor": at, "key": key, "label": labels, "vectors": matrix})
        best_same = _ranked(file.mapInArrow(lambda it, lines=lines: _search(it, lines, packing, positives, None),
                                            found_schema), positives)
        chosen = best_same.orderBy("line", "rank").toArrow()  # at most PASS_ANCHORS * positives rows
        if not chosen.num_rows:
            continue
        anchor_at = np.searchsorted(key, chosen.column("line").to_numpy())
        scores = chosen.column("score").to_numpy()
        number = np.arange(len(anchor_at))
        pairs = spark.sparkContext.broadcast({
            "line": number, "anchor": anchor_at, "key": key[anchor_at], "label": labels[anchor_at],
            "positive_score": scores, "vectors": matrix})
        other = _ranked(file.mapInArrow(
            lambda it, pairs=pairs: _search(it, pairs, packing, negatives, (low, high)), found_schema), negatives)
        names = spark.createDataFrame(pa.table({
            "line": number, "anchor_id": ids[anchor_at], "positive_id": chosen.column("vec_id"),
            "positive_score": scores}))
        got = materialize(other.join(names, "line").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")))
        out = got if out is None else out.unionByName(got)
    return out if out is not None else spark.createDataFrame([], OUT)
