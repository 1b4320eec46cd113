"""N-gram Jaccard join as a blocked sparse matrix product.

The documents-by-shingles incidence matrix ``A`` is multiplied by its own
transpose, in blocks, and only where the product can reach the threshold:

1. one pass over the texts gives each document's set size, a signature of
   its shingle set (equal sets are one row of the matrix from here on) and a
   sketch of it, and counts documents per hash bucket of columns;
2. columns are ordered by that count, rare first. Two sets of Jaccard
   similarity ``t`` share a column among the first ``n - ceil(t n) + 1`` of
   each (the head). Only head columns are multiplied out;
3. a head column with few rows yields its pairs of rows, unless their sizes
   or sketches rule out ``t``. A column with many rows (a family of near
   copies, a shared passage) never yields pairs: its rows are tied where their
   sketches do not rule out ``t``, ties make clusters, and a cluster is cut
   into blocks of rows of like size; blocks whose sizes rule out ``t`` are not
   multiplied;
4. the surviving pairs and block pairs get their full rows, and one task
   accumulates exact overlap counts of one block pair;
5. links become components.

Every pair of similar texts is in some unit of step 4, so the links are
exact: a sketch bounds the overlap from above, it never decides a link.
Without sketches the rows that share no more than a passage would be tied, and
the longer the table, the more of them have a shared passage in their heads
(buckets fill up) and the more of their clusters grow together. Columns
holding many rows are salted by row before the shuffle; a column's parts are
tied together afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.components import connected_components
from cadastra.llm.running import small_batches
from cadastra.llm.shingles import set_signature, shingle_set
from cadastra.operators.materialize import drop_table, known_rows, materialize

COUNT_BITS = 22  # columns are counted in 2**22 hash buckets: a table of fixed size (16 MB)
PART_BITS = 12  # buckets of one part of that table
PAIR_ROWS = 16  # columns with at most this many rows yield pairs
SALT_ROWS = 1024  # rows of one part of a salted column
BLOCK_ROWS = 2048  # rows of one block of a cluster, at most
BLOCK_SHINGLES = 1 << 20  # and shingles of one block, about
PAIR_UNIT = 512  # partners of a row in one unit
BROADCAST_ROWS = 500_000  # rows of two or three numbers that are broadcast; beyond, a shuffle join
DENSE = 200  # a column that adds to one cell in so many of a block product is multiplied as a dense one
PRODUCT_CELLS = 1 << 20  # cells added at once, about
PRODUCT_COLUMNS = 4096  # columns multiplied at once
SLICE_TEXTS = 256  # texts whose shingles are in a task's memory at once
KNOWN_SETS = 100_000  # signatures a task remembers, to pass over copies early
SKETCH_CELLS = 64  # cells of a sketch, at least
CELL_SHINGLES = 8  # shingles of a cell on average, at most


def _need(n, percent: int):
    return (percent * n + 99) // 100  # ceil(t n)


# ---- step 1: sizes, signatures, column counts --------------------------------------------


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_TEXTS):
            yield batch.slice(at, SLICE_TEXTS)


def sketch(s: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall into each of some cells (255: as many or more); larger sets have more cells."""
    cells = max(SKETCH_CELLS, 1 << (len(s) // CELL_SHINGLES).bit_length())
    counts = np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.minimum(counts, 255).astype(np.uint8)


def _scan(batches: Iterator[pa.RecordBatch], words: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << COUNT_BITS, np.uint32)  # documents of one task
    shift = np.uint64(64 - COUNT_BITS)
    for batch in _slices(batches):
        sigs, sizes, sketches, hashes = [], [], [], []
        for text in batch.column(1).to_pylist():
            s = shingle_set(text, words)
            sizes.append(len(s))
            sigs.append(set_signature(s) if len(s) else None)
            sketches.append(sketch(s).tobytes() if len(s) else None)
            hashes.append((s >> shift).astype(np.uint32))
        np.add.at(counts, np.concatenate(hashes), np.uint32(1))
        k = len(sigs)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(id_type), batch.column(2), pa.array(sigs, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(sketches, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
            names=["doc_id", "text_hash", "sig", "n", "sketch", "part", "counts"])
    rows = []
    for part, c in enumerate(counts.reshape(-1, 1 << PART_BITS)):
        if top := int(c.max()):
            rows.append((part, _pack(c, top)))
    if rows:
        k = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, id_type), *[pa.nulls(k, pa.int64())] * 3, pa.nulls(k, pa.binary()),
             pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
            names=["doc_id", "text_hash", "sig", "n", "sketch", "part", "counts"])


def _width(top: int) -> int:
    """Bytes of the narrowest unsigned integer that holds ``top``."""
    return next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)


def _pack(counts: np.ndarray, top: int) -> bytes:
    """Counts of one part in the narrowest integers that hold the largest, ``top``."""
    return counts.astype(f"<u{_width(top)}").tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{len(blob) >> PART_BITS}").astype(np.int64)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[part] = total.get(part, 0) + _unpack(blob)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([_pack(v, int(v.max())) for v in total.values()], pa.binary())],
            names=["part", "counts"])


def column_counts(scanned: DataFrame) -> np.ndarray:
    """Documents per column bucket: a table of ``2**COUNT_BITS`` numbers, whatever the input.

    It only orders columns: the many rare columns of a bucket add about the same to every bucket, so
    a column of many rows stands out from its bucket's share as long as it exceeds the spread of that share.
    """
    parts = scanned.where("part IS NOT NULL").select("part", "counts")
    summed = parts.repartition("part").mapInArrow(_sum_counts, "part int, counts binary")
    out = np.zeros((1 << COUNT_BITS - PART_BITS, 1 << PART_BITS), np.uint32)
    for part, blob in summed.toLocalIterator():  # 1024 rows of fixed size
        out[part] = np.minimum(_unpack(blob), 0xFFFFFFFF)
    # as narrow as the largest count allows: the table goes to every task that orders columns
    return out.ravel().astype(f"<u{_width(int(out.max()))}")


# ---- steps 2 and 3: head columns, candidates ---------------------------------------------


def _heads(batches, words: int, percent: int, counts: np.ndarray, salt_rows: int) -> Iterator[pa.RecordBatch]:
    shift = np.uint64(64 - COUNT_BITS)
    usual = 4 * int(counts.mean()) + salt_rows
    seen: set[int] = set()
    for batch in _slices(batches):
        cols, sigs, sizes, salts = [], [], [], []
        for text in batch.column(0).to_pylist():
            s = shingle_set(text, words)
            n = len(s)
            if n == 0:
                continue
            sig = set_signature(s)
            if sig in seen:  # a copy within this task: the same row of the matrix
                continue
            if len(seen) < KNOWN_SETS:
                seen.add(sig)
            k = n - _need(n, percent) + 1
            c = counts[(s >> shift).astype(np.int64)]
            if k < n:
                top = np.argsort(c, kind="stable")[:k]  # by count, then by hash: the set is sorted
                s, c = s[top], c[top]
            parts = 1 + np.maximum(0, c.astype(np.int64) - usual) // salt_rows
            cols.append(s.view(np.int64))
            sigs.append(np.full(len(s), sig, np.int64))
            sizes.append(np.full(len(s), n, np.int32))
            salts.append(np.where(parts > 1, 1 + (sig & 0x7FFFFFFF) % parts, 0).astype(np.int32))
        if cols:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (cols, salts, sigs, sizes)],
                names=["col", "salt", "sig", "n"])
    pa.default_memory_pool().release_unused()  # an idle worker keeps no more than its tables


def _candidates(batches, percent: int, pair_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (col, salt, sig) in; kind 0: a pair, 1: a tie, 2: a salted column's part, 3: a row of a group.

    A group is the rows of a column with many rows; columns of the same rows are one group.
    """

    def runs(col, salt, sig, n):
        new = np.flatnonzero(np.r_[True, (col[1:] != col[:-1]) | (salt[1:] != salt[:-1])])
        size = np.diff(np.r_[new, len(col)])
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def pairs(a, b):
            na, nb = n[a].astype(np.int64), n[b].astype(np.int64)
            ok = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
            x, y = sig[a[ok]], sig[b[ok]]
            out.append((np.zeros(len(x), np.int8), np.minimum(x, y), np.maximum(x, y)))

        plain = salt[new] == 0
        for k in range(2, pair_rows + 1):
            at = new[(size == k) & plain]
            if len(at):
                i, j = np.triu_indices(k, 1)
                pairs((at[:, None] + i).ravel(), (at[:, None] + j).ravel())
        for at, k in zip(new[(size > pair_rows) & plain], size[(size > pair_rows) & plain]):
            members = sig[at : at + k]
            out.append((np.full(k, 3, np.int8), np.full(k, set_signature(members)), members))
        for at, k in zip(new[~plain], size[~plain]):
            members = sig[at : at + k]
            out.append((np.ones(k - 1, np.int8), np.full(k - 1, members[0]), members[1:]))
            out.append((np.full(1, 2, np.int8), col[at : at + 1], members[:1]))
        if not out:
            return None
        kind, a, b = (np.concatenate(x) for x in zip(*out))
        if len(kind) == 0:
            return None
        order = np.lexsort((b, a, kind))
        kind, a, b = kind[order], a[order], b[order]
        new = np.r_[True, (kind[1:] != kind[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        return pa.RecordBatch.from_arrays(
            [pa.array(c[new]) for c in (kind, a, b)], names=["kind", "a", "b"])

    carry = None
    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if carry is not None:
            now = [np.concatenate(x) for x in zip(carry, now)]
        if len(now[0]) == 0:
            continue
        same = np.r_[False, (now[0][1:] == now[0][:-1]) & (now[1][1:] == now[1][:-1]) & (now[2][1:] == now[2][:-1])]
        now = [x[~same] for x in now]  # a copy that another task has sent too
        last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
        cut = last[-1] + 1 if len(last) else 0
        carry = [x[cut:] for x in now]
        if cut and (made := runs(*[x[:cut] for x in now])) is not None:
            yield made
    if carry is not None and len(carry[0]) and (made := runs(*carry)) is not None:
        yield made
    pa.default_memory_pool().release_unused()  # an idle worker keeps no more than its tables


# ---- step 3: what sketches rule out ---------------------------------------------------------


def _folded(cells: np.ndarray, width: int) -> np.ndarray:
    """Sketches (one a row) of fewer cells: exactly what ``sketch`` would count with so many."""
    if cells.shape[1] == width:
        return cells
    return np.minimum(cells.reshape(len(cells), -1, width).sum(axis=1, dtype=np.int64), 255).astype(np.uint8)


class Sketches:
    """Rows by their sketches: which of them may be similar to a given one.

    Where two sets' counts of a cell differ by ``d``, at least ``d`` shingles are in one set only. So the
    differences of all cells bound the overlap from above, and no similar pair is ruled out.
    """

    def __init__(self, sizes: list[int], blobs: list[bytes], percent: int):
        self.n, self.percent = np.array(sizes, np.int64), percent
        width = np.array([len(b) for b in blobs])
        self.cells = [np.frombuffer(b, np.uint8) for b in blobs]
        self.parts = [(at, np.stack([self.cells[i] for i in at])) for at in (np.flatnonzero(width == w) for w in np.unique(width))]

    def near(self, n: int, cells: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Places, of those marked in ``among``, that a row of ``n`` shingles with these ``cells`` may be similar to."""
        among = among & (100 * np.minimum(self.n, n) >= self.percent * np.maximum(self.n, n))
        found = []
        for at, matrix in self.parts:
            some = among[at]
            if not some.any():
                continue
            at, width = at[some], min(matrix.shape[1], len(cells))
            a, b = _folded(matrix[some], width), _folded(cells[None, :], width)
            apart = (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64)
            found.append(at[(100 - self.percent) * (self.n[at] + n) >= (100 + self.percent) * apart])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _keyed(batches) -> Iterator[tuple[int, list[tuple]]]:
    """Rows sorted by their first column in; per value of it the rest of its rows out."""
    key, rows = None, []
    for batch in batches:
        for k, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if rows:
                    yield key, rows
                key, rows = k, []
            rows.append(rest)
    if rows:
        yield key, rows


def _tied(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (group, sig, n, sketch) sorted by group in; ties out that join what may be similar within a group."""
    for _, rows in _keyed(batches):
        sig, n, blobs = zip(*rows)
        held = Sketches(n, blobs, percent)
        label = np.arange(len(rows))
        for i in range(len(rows) - 1):
            other = label != label[i]
            other[:i] = False  # these have met row i
            if other.any() and len(hit := held.near(n[i], held.cells[i], other)):
                label[np.isin(label, label[hit])] = label[i]
        ids = np.array(sig, np.int64)
        a, b = ids[label], ids
        if (a != b).any():
            yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])
    pa.default_memory_pool().release_unused()


def _likely(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (unit, side, sig, n, sketch) of pair units sorted by unit in; those that may have a partner out."""
    for unit, rows in _keyed(batches):
        left, right = ([r[1:] for r in rows if r[0] == side] for side in (0, 1))
        if not left or not right:
            continue
        held = Sketches([r[1] for r in right], [r[2] for r in right], percent)
        kept, met = [], np.zeros(len(right), bool)
        for sig, n, blob in left:
            hit = held.near(n, np.frombuffer(blob, np.uint8), np.ones(len(right), bool))
            met[hit] = True
            if len(hit):
                kept.append(sig)
        if kept:
            other = [right[i][0] for i in np.flatnonzero(met)]
            k = len(kept) + len(other)
            yield pa.RecordBatch.from_arrays(
                [pa.array([unit] * k, pa.int64()), pa.array([0] * len(kept) + [1] * len(other), pa.int32()),
                 pa.array(kept + other, pa.int64())], names=["unit", "side", "sig"])
    pa.default_memory_pool().release_unused()


# ---- step 4: units of block pairs ---------------------------------------------------------


def _pair_units(pairs: DataFrame) -> DataFrame:
    """Pairs grouped by their smaller row; a row with many partners is split."""
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("k"))
    p = pairs.join(many, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("k") / PAIR_UNIT).cast("long")).alias("s"))
    unit = F.xxhash64(F.lit("pair"), "a", "s")
    left = p.select(unit.alias("unit"), F.lit(0).alias("side"), F.col("a").alias("sig")).distinct()
    return left.union(p.select(unit.alias("unit"), F.lit(1).alias("side"), F.col("b").alias("sig")))


def _block_units(members: DataFrame, percent: int) -> DataFrame:
    """``members``: (sig, n, root). Blocks of one size band; a block meets its band and the next."""
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("long")
    m = members.withColumn("band", band)
    parts = materialize(m.groupBy("root", "band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("parts")))
    below = parts.select("root", (F.col("band") + 1).alias("band"), F.col("parts").alias("below"))
    above = parts.select("root", (F.col("band") - 1).alias("band"), F.col("parts").alias("above"))
    m = m.join(parts, ["root", "band"]).join(below, ["root", "band"], "left").join(above, ["root", "band"], "left")
    m = m.withColumn("s", F.pmod(F.xxhash64("sig"), F.col("parts")))

    def meet(my_side: int, lo, hi, unit):
        return F.transform(F.sequence(lo, hi), lambda x: F.struct(unit(x).alias("unit"), F.lit(my_side).alias("side")))

    def name(band, s, next_band, next_s):
        return F.xxhash64(F.lit("block"), F.col("root"), band, s, next_band, next_s)

    none = F.array().cast("array<struct<unit:bigint,side:int>>")
    b, s = F.col("band"), F.col("s")
    units = F.concat(
        meet(0, s, F.col("parts") - 1, lambda x: name(b, s, b, x)),
        F.when(s > 0, meet(1, F.lit(0).cast("long"), s - 1, lambda x: name(b, x, b, s))).otherwise(none),
        F.when(F.col("above").isNotNull(),
               meet(0, F.lit(0).cast("long"), F.col("above") - 1, lambda x: name(b, s, b + 1, x))).otherwise(none),
        F.when(F.col("below").isNotNull(),
               meet(1, F.lit(0).cast("long"), F.col("below") - 1, lambda x: name(b - 1, x, b, s))).otherwise(none),
    )
    return m.select("sig", F.explode(units).alias("u")).select("u.unit", "u.side", "sig")


def overlap_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Product of two blocks of rows: overlap counts, by slices of the columns both have."""
    def coo(rows):
        return np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    out = np.zeros((len(left), len(right)), np.float32)
    (lc, lr), (rc, rr) = coo(left), coo(right)
    both = np.intersect1d(lc, rc)
    if len(both) == 0:
        return out.astype(np.int64)

    def index(cols, rows):
        at = np.searchsorted(both, cols)
        at[at == len(both)] = 0
        ok = both[at] == cols
        at, rows = at[ok], rows[ok]
        order = np.argsort(at, kind="stable")
        return at[order], rows[order]

    (lc, lr), (rc, rr) = index(lc, lr), index(rc, rr)
    bounds = np.arange(len(both) + 1)
    l_at, r_at = np.searchsorted(lc, bounds), np.searchsorted(rc, bounds)
    meets = np.diff(r_at)  # right rows of each column
    dense = np.diff(l_at) * meets * DENSE >= out.size

    # sparse columns: each of their cells on the left is added to the column's rows on the right
    flat, some = out.ravel(), np.flatnonzero(~dense[lc])
    upto = np.cumsum(meets[lc[some]])
    cuts = np.searchsorted(upto, np.arange(PRODUCT_CELLS, upto[-1], PRODUCT_CELLS)) + 1 if len(some) else []
    for part in np.split(some, np.unique(cuts).astype(np.int64)):
        k = meets[lc[part]]
        at = np.repeat(r_at[lc[part]] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        np.add.at(flat, np.repeat(lr[part], k) * len(right) + rr[at], np.float32(1))

    # dense columns: slices of both matrices are filled and multiplied
    cols = np.flatnonzero(dense)
    for lo in range(0, len(cols), PRODUCT_COLUMNS):
        some = cols[lo : lo + PRODUCT_COLUMNS]
        sides = []
        for c, r, rows in ((lc, lr, len(left)), (rc, rr, len(right))):
            m = np.zeros((rows, len(some)), np.float32)
            a, b = np.searchsorted(c, some[0]), np.searchsorted(c, some[-1], "right")
            a, b = c[a:b][dense[c[a:b]]], r[a:b][dense[c[a:b]]]
            m[b, np.searchsorted(some, a)] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _link_unit(rows: dict[int, dict[int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links of one unit, reduced to one tie per row and component within the unit."""
    left = rows.get(0, {})
    right = rows.get(1) or left  # a block with itself has one side only
    if not left or not right:
        return []
    a, b = list(left), list(right)
    na, nb = (np.array([len(v) for v in side.values()]) for side in (left, right))
    over = overlap_counts(list(left.values()), list(right.values()))
    link = 100 * over >= percent * (na[:, None] + nb[None, :] - over)
    ids = np.array(sorted({*a, *b}))
    pa_, pb = np.searchsorted(ids, a), np.searchsorted(ids, b)
    label = np.arange(len(ids))
    big = len(ids)
    while True:  # smallest label over the links, until nothing changes
        old = label.copy()
        up = np.where(link, label[pb][None, :], big).min(axis=1)
        np.minimum.at(label, pa_, up)
        down = np.where(link, label[pa_][:, None], big).min(axis=0)
        np.minimum.at(label, pb, down)
        if (label == old).all():
            break
    return [(int(ids[i]), int(ids[k])) for i, k in enumerate(label) if i != k]


def _multiply(batches, words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (unit, side, sig, text) sorted by unit in; ties between rows out."""
    unit, rows = None, {}

    def made(links):
        a, b = zip(*links)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for u, side, sig, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if u != unit:
                if rows and (links := _link_unit(rows, percent)):
                    yield made(links)
                unit, rows = u, {}
            s = shingle_set(text, words)
            if len(s) and set_signature(s) == sig:  # a doc_id may name several texts
                rows.setdefault(side, {})[sig] = s
    if rows and (links := _link_unit(rows, percent)):
        yield made(links)
    pa.default_memory_pool().release_unused()  # an idle worker keeps no more than its tables


def _small(table: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its counted rows (of a few numbers) are within the bound."""
    n = known_rows(table)
    return F.broadcast(table) if n is not None and n <= BROADCAST_ROWS else table


def _texts(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of every wanted set, written: sig, text. ``wanted`` (sig, rep, text_hash) is a written table.

    A text is found by its id and its hash, so rows without id, or of one id,
    do not meet each other's sets; only rows repeated as they are come more
    than once, and then all but one of them go.
    """
    s, w = src.withColumn("text_hash", F.xxhash64("text")), _small(wanted)
    found = materialize(s.join(w, s.doc_id.eqNullSafe(w.rep) & (s.text_hash == w.text_hash)).select("sig", "text"))
    if known_rows(found) > known_rows(wanted):
        once = materialize(found.dropDuplicates(["sig"]))
        drop_table(found)
        return once
    return found


# ---- the operator ------------------------------------------------------------------------


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate components of a table of texts.

    Returns ``rows`` (doc_id, text_hash, sig, n: one per input row, written) and ``groups``
    (sig, root, component_id: one per shingle set that is linked or repeated;
    ``component_id`` is the smallest id of the component). A row whose ``sig``
    is null (no words, null text) or not in ``groups`` is alone.

    Null ids: such rows take part; ``component_id`` is the smallest id that is
    not null, or null. Repeated rows and ids, extra columns and empty tables
    are fine.
    """
    with small_batches(docs.sparkSession):  # every step with Python in it is written inside
        return _components(docs, id_col, text_col, words, percent)


def _components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession

    scanned = materialize(src.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        lambda it: _scan(it, words, pa.int64()),
        "doc_id long, text_hash long, sig long, n long, sketch binary, part int, counts binary"))
    counts = column_counts(scanned)
    rows = scanned.where("part IS NULL").select("doc_id", "text_hash", "sig", "n")
    by_id = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)"))  # rows without id last
    classes = materialize(rows.where("sig IS NOT NULL").groupBy("sig").agg(
        F.min("doc_id").alias("rep"), F.min_by("text_hash", by_id).alias("text_hash"), F.max("n").alias("n"),
        F.count(F.lit(1)).alias("copies")))

    heads = src.select("text").mapInArrow(
        lambda it: _heads(it, words, percent, counts, SALT_ROWS), "col long, salt int, sig long, n int")
    found = materialize(
        heads.repartition("col", "salt").sortWithinPartitions("col", "salt", "sig")
        .mapInArrow(lambda it: _candidates(it, percent, PAIR_ROWS), "kind byte, a long, b long").distinct())

    # the sketches of all rows in pairs and groups: one of each set
    met = materialize(found.where("kind = 0").select(F.explode(F.array("a", "b")).alias("sig"))
                      .union(found.where("kind = 3").select("b")).distinct())
    sketches = materialize(
        scanned.where("sig IS NOT NULL").select("sig", "n", "sketch").join(_small(met), "sig").dropDuplicates(["sig"]))

    groups = found.where("kind = 3").select(F.col("a").alias("group"), F.col("b").alias("sig"))
    near = materialize(
        groups.join(sketches, "sig").select("group", "sig", "n", "sketch")
        .repartition("group").sortWithinPartitions("group")
        .mapInArrow(lambda it: _tied(it, percent), "a long, b long").distinct())

    parts = found.where("kind = 2").select(F.col("a").alias("col"), F.col("b").alias("sig"))
    firsts = materialize(parts.groupBy("col").agg(F.min("sig").alias("first")))
    ties = near.union(found.where("kind = 1").select("a", "b")).union(
        parts.join(firsts, "col").select(F.col("first").alias("a"), F.col("sig").alias("b")))
    clusters = materialize(connected_components(ties))

    pairs = found.where("kind = 0").select("a", "b")
    ca = clusters.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    cb = clusters.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    pairs = pairs.join(ca, "a", "left").join(cb, "b", "left").where(
        "ra IS NULL OR rb IS NULL OR ra <> rb").select("a", "b")
    members = clusters.select(F.col("node").alias("sig"), "root").join(
        classes.select("sig", "n"), "sig")
    likely = (
        _pair_units(materialize(pairs)).join(sketches, "sig").select("unit", "side", "sig", "n", "sketch")
        .repartition("unit").sortWithinPartitions("unit")
        .mapInArrow(lambda it: _likely(it, percent), "unit long, side int, sig long"))
    units = materialize(likely.union(_block_units(members, percent)))

    texts = _texts(src, materialize(units.select("sig").distinct().join(classes.select("sig", "rep", "text_hash"), "sig")))
    links = materialize(
        _small(units).join(texts, "sig").select("unit", "side", "sig", "text")
        .repartition("unit").sortWithinPartitions("unit", "side")
        .mapInArrow(lambda it: _multiply(it, words, percent), "a long, b long").distinct())
    for t in (found, met, sketches, near, units, texts):
        drop_table(t)

    linked = connected_components(links)
    groups = linked.select(F.col("node").alias("sig"), "root").join(classes.select("sig", "rep"), "sig")
    alone = classes.where("copies > 1").select("sig", F.col("sig").alias("root"), "rep").join(
        linked.select(F.col("node").alias("sig")), "sig", "left_anti")
    groups = materialize(groups.select("sig", "root", "rep").union(alone))
    low = materialize(groups.groupBy("root").agg(F.min("rep").alias("component_id")))
    return rows, materialize(groups.join(low, "root").select("sig", "root", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links).

    A document without words is alone: its component_id is its own id.
    """
    rows, groups = jaccard_components(docs, id_col, text_col, words, percent)
    # the rows without a set get keys of their own, so they do not meet in one task
    key = F.coalesce(F.col("sig"), F.xxhash64("doc_id"))
    out = rows.withColumn("_k", key).join(
        groups.select(F.col("sig").alias("_k"), F.lit(True).alias("_in"), "component_id"), "_k", "left")
    alone = F.col("sig").isNull() | F.col("_in").isNull()
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The input rows with one row per near-duplicate component: that of the smallest doc_id.

    Rows without words all stay. Of repeated rows with that doc_id, one stays.
    A component whose ids are all null keeps one row.
    """
    from pyspark.sql import Window

    rows, groups = jaccard_components(docs, words=words, percent=percent)
    # equal texts have equal sets: a row finds its group by the hash of its text, and no text is shingled again
    members = materialize(rows.join(groups, "sig").groupBy("text_hash").agg(
        F.min(F.struct("root", "component_id")).alias("_g")).select("text_hash", "_g.root", "_g.component_id"))
    # which rows go is settled on ids and hashes: of a component, all but (its smallest id, that id's smallest hash)
    grouped = materialize(rows.select("doc_id", "text_hash").join(_small(members), "text_hash")
                          .groupBy("root", "component_id", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")))
    first = grouped.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("text_hash").alias("_first"))
    marked = grouped.join(first, "root").withColumn(
        "_stays", F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("_first")))
    names = [F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")]
    out = materialize(marked.where("NOT _stays OR n > 1").select(*names))
    repeated = materialize(marked.where("_stays AND n > 1").select(*names))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                    F.col("doc_id").cast("long").alias("_d"), F.xxhash64(F.col("text").cast("string")).alias("_k"))
    same = F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_hash"))
    kept = d.join(_small(out), same, "left_anti").select("_row")
    order = Window.partitionBy("_d", "_k").orderBy(F.xxhash64("_row"))
    once = d.join(_small(repeated), same, "left_semi").withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return kept.union(once.select("_row")).select("_row.*")
