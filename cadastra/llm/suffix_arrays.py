"""Benchmark decontamination with suffix arrays over the training documents.

``build`` cuts the documents into shards of whole documents and writes, per
shard, its words as numbers, the shard's word list, and the suffix array: the
positions of all words, sorted by the words that follow. Every document ends
with a separator of its own, so no match runs from one document into the next.

``search`` takes the test items in passes of bounded size. In every shard each
test suffix is looked up by binary search, word by word and for all suffixes at
once, until its range of the suffix array is that of a window: ``window``
consecutive words, or the whole item where it has fewer. All positions in that
range are verbatim occurrences. ``matches`` follows the range further and gives
the longest match of every test suffix with its place.

Words are compared as words, not as hashes. ``A-Z`` is lower-cased; a word is a
run of digits, ``a-z`` and non-ASCII characters. A null or empty text has no
words. Rows of a repeated document id are documents of their own, rows of a
repeated item id are one item (its windows are those of all its rows); an item
without id counts as an item and adds an empty string to the digest. Empty
tables give no rows, or rows without hits. Columns other than the named ones
are not read.

A shard closes with the document that fills it, so a text longer than a shard
makes a longer one: a task needs memory in proportion to the longest text.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.running import large_rows, number_rows, small_batches
from cadastra.operators.materialize import materialize

SHARD_WORDS = 1 << 19
PASS_WORDS = 1 << 21  # words of the test items that a task holds at once
BATCH_TEXTS = 256  # texts that go to a task's Python worker at once
GROUP_BYTES = 1 << 24  # bytes of a row group of shards, about
_SEPARATE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 0x20 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_SEPARATE).split()


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Positions of ``s`` sorted by what follows (prefix doubling; only still tied suffixes are sorted again)."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    bits = max(1, int(s.max()).bit_length())
    deep = min(n, max(1, 62 // bits))
    key = np.zeros(n, np.int64)
    for j in range(deep):
        key <<= bits
        key[: n - j] |= s[j:]
    sa = np.argsort(key, kind="stable")
    new = np.r_[True, key[sa][1:] != key[sa][:-1]]
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.zeros(n + 1, np.int64)
    rank[sa] = start
    tied = ~(new & np.r_[new[1:], True])
    at = np.nonzero(tied)[0]
    while len(at):
        sub = sa[at]
        key = (rank[sub] << 32) | (rank[np.minimum(sub + deep, n)] + (sub + deep < n))
        order = np.argsort(key, kind="stable")
        sub, key = sub[order], key[order]
        sa[at] = sub
        new = np.r_[True, key[1:] != key[:-1]]
        start = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        rank[sub] = start
        at = at[~(new & np.r_[new[1:], True])]
        deep *= 2
    return sa


class _Shard:
    """Documents gathered into one shard."""

    def __init__(self):
        self.numbers = defaultdict(count().__next__)
        self.parts, self.ids, self.sizes, self.held = [], [], [], 0

    def add(self, doc_id, text):
        w = words(text)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, w), np.int64, len(w)))
        self.ids.append(doc_id)
        self.sizes.append(len(w))
        self.held += len(w) + 1

    def tokens(self) -> np.ndarray:
        docs = len(self.ids)
        out = np.empty(self.held, np.int64)
        at = 0
        for i, part in enumerate(self.parts):  # separators 0..docs-1, then the words
            out[at : at + len(part)] = part + docs
            out[at + len(part)] = i
            at += len(part) + 1
        return out


def _build(batches, shard_words: int, id_type: pa.DataType):
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32

    def made(shard):
        t = shard.tokens()
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([b" ".join(shard.numbers)]),
            pa.array([t.astype("<u4").tobytes()]), pa.array([suffix_array(t).astype("<u4").tobytes()]),
            pa.array([shard.ids], pa.list_(id_type)), pa.array([shard.sizes], pa.list_(pa.int64())),
        ], names=["shard", "words", "tokens", "suffixes", "ids", "sizes"])

    shard = _Shard()
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            shard.add(doc_id.as_py(), text.as_py())
            if shard.held >= shard_words:
                yield made(shard)
                number += 1
                shard = _Shard()
    if shard.ids:
        yield made(shard)


def build(docs: DataFrame, shard_words: int = SHARD_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the suffix arrays of all documents; one row per shard."""
    from pyspark.sql.pandas.types import to_arrow_type

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType
    arrow = to_arrow_type(kind)
    with small_batches(docs.sparkSession, BATCH_TEXTS):
        return materialize(src.mapInArrow(
            lambda it: _build(it, shard_words, arrow),
            f"shard long, words binary, tokens binary, suffixes binary, ids array<{kind.simpleString()}>, sizes array<long>"),
            **_shard_files())


def _shard_files() -> dict[str, str]:
    """Parquet's writer looks at sizes after 100 rows only, which here are some 500 MB: it is to look after each."""
    return {"parquet.block.size": str(GROUP_BYTES), "parquet.page.size.row.check.min": "1",
            "parquet.page.size.row.check.max": "1"}


class Items:
    """Test items as one run of word numbers."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        numbers = defaultdict(count().__next__)
        parts = [words(t) for t in texts]
        self.ids = ids
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.tokens = np.fromiter((numbers[w] for p in parts for w in p), np.int64, int(self.sizes.sum()))
        self.numbers = dict(numbers)
        ends = np.cumsum(self.sizes)
        need = np.minimum(self.sizes, window)
        starts = [np.arange(e - n, e - k + 1) for e, n, k in zip(ends, self.sizes, need) if n]
        self.at = np.concatenate(starts) if starts else np.zeros(0, np.int64)  # starts of windows
        self.item = np.repeat(np.arange(len(ids)), np.where(self.sizes > 0, self.sizes - need + 1, 0))
        self.need, self.end = need[self.item], ends[self.item]
        self.start = (ends - self.sizes)[self.item]


class Searcher:
    """Binary search of test suffixes in one shard."""

    def __init__(self, vocabulary: bytes, tokens: bytes, suffixes: bytes, docs: int, items: Items):
        self.s, self.sa = np.frombuffer(tokens, "<u4").astype(np.int64), np.frombuffer(suffixes, "<u4").astype(np.int64)
        local = np.full(len(items.numbers) + 1, -1, np.int64)  # test word -> its number in the shard
        get = items.numbers.get
        here = [get(w, -1) for w in vocabulary.split(b" ")] if vocabulary else []
        local[here] = np.arange(len(here)) + docs  # words that the items lack land in the spare last place
        local[-1] = -1
        self.test = local[items.tokens]
        self.begin = np.searchsorted(self.s[self.sa], np.arange(docs + len(here) + 1))

    def _bound(self, lo, hi, offset, value, after: bool):
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.nonzero(lo < hi)[0]
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            seen = self.s[self.sa[mid] + offset[open_]]
            right = seen <= value[open_] if after else seen < value[open_]
            lo[open_] = np.where(right, mid + 1, lo[open_])
            hi[open_] = np.where(right, hi[open_], mid)

    def first(self, at: np.ndarray):
        """Ranges of the suffixes that share the first word of the test suffixes ``at``."""
        w = self.test[at]
        ok = w >= 0
        w = np.where(ok, w, 0)
        return np.where(ok, self.begin[w], 0), np.where(ok, self.begin[w + 1], 0)

    def narrow(self, lo, hi, at, depth: np.ndarray):
        """Ranges, ``depth`` words deep, narrowed by one more word."""
        value = self.test[at + depth]
        new_lo = self._bound(lo, hi, depth, value, False)
        new_hi = self._bound(new_lo, hi, depth, value, True)
        return new_lo, new_hi

    def windows(self, items: Items):
        """(lo, hi) of every window; an empty range where it does not occur."""
        lo, hi = self.first(items.at)
        for depth in range(1, int(items.need.max(initial=0))):
            on = np.nonzero((lo < hi) & (items.need > depth))[0]
            if not len(on):
                break
            lo[on], hi[on] = self.narrow(lo[on], hi[on], items.at[on], np.full(len(on), depth))
        return lo, hi

    def longest(self, at: int, lo: int, hi: int, depth: int, end: int):
        """Longest match of one test suffix whose range is known ``depth`` words deep: (length, lo, hi)."""
        while at + depth < end:
            # all suffixes of a sorted range share what its first and its last one share
            ahead = min(self._common(self.sa[lo] + depth, at + depth, end), self._common(self.sa[hi - 1] + depth, at + depth, end))
            depth += ahead
            if at + depth >= end:
                break
            one = np.array([at])
            a, b = self.narrow(np.array([lo]), np.array([hi]), one, np.array([depth]))
            if a[0] >= b[0]:
                break
            lo, hi, depth = int(a[0]), int(b[0]), depth + 1
        return depth, lo, hi

    def _common(self, p: int, t: int, end: int) -> int:
        got, step = 0, 16
        while True:
            n = min(step, end - t - got, len(self.s) - p - got)
            if n <= 0:
                return got
            off = np.nonzero(self.s[p + got : p + got + n] != self.test[t + got : t + got + n])[0]
            if len(off):
                return got + int(off[0])
            got += n
            step *= 2


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one range after the other."""
    n = hi - lo
    return np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))


def _hits(batches, shared):
    """Shards in; per document with occurrences its hit stretches and the items whose windows occur."""
    items = shared.value
    for batch in batches:
        for number, vocabulary, tokens, suffixes, sizes in zip(*(batch.column(i) for i in range(5))):
            sizes = np.array(sizes.as_py(), np.int64)
            found = Searcher(vocabulary.as_py(), tokens.as_py(), suffixes.as_py(), len(sizes), items)
            lo, hi = found.windows(items)
            there = np.nonzero(lo < hi)[0]
            if not len(there):
                continue
            # equal windows have one range: their positions are read once
            ranges, group = np.unique(np.stack([lo[there], hi[there], items.need[there]], axis=1), axis=0, return_inverse=True)
            group = group.ravel()
            of_range = [np.unique(x) for x in np.split(items.item[there][np.argsort(group, kind="stable")],
                                                       np.cumsum(np.bincount(group))[:-1])]
            n = ranges[:, 1] - ranges[:, 0]
            position = found.sa[_ranges(ranges[:, 0], ranges[:, 1])]
            length, which = np.repeat(ranges[:, 2], n), np.repeat(np.arange(len(ranges)), n)
            change = np.zeros(len(found.s) + 1, np.int64)
            np.add.at(change, position, 1)
            np.add.at(change, position + length, -1)
            covered = np.r_[0, (np.cumsum(change[:-1]) > 0).astype(np.int8), 0]
            edge = np.diff(covered)
            begin, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
            starts = np.cumsum(sizes + 1) - (sizes + 1)
            stretch_doc = np.searchsorted(starts, begin, side="right") - 1
            pair = np.unique(np.stack([np.searchsorted(starts, position, side="right") - 1, which], axis=1), axis=0)
            docs, first = np.unique(pair[:, 0], return_index=True)
            sets: dict[bytes, list[str]] = {}
            out = ([], [], [], [])
            for doc, has in zip(docs, np.split(pair[:, 1], first[1:])):
                ids = sets.get(has.tobytes())  # copies share their items
                if ids is None:
                    ids = sets[has.tobytes()] = sorted({items.ids[i] for i in np.unique(np.concatenate([of_range[r] for r in has]))})
                a, b = np.searchsorted(stretch_doc, [doc, doc + 1])
                out[0].append(int(doc))
                out[1].append([int(x) for x in begin[a:b] - starts[doc]])
                out[2].append([int(x) for x in end[a:b] - starts[doc]])
                out[3].append(ids)
            yield pa.RecordBatch.from_arrays([
                pa.array([number.as_py()] * len(out[0]), pa.int64()), pa.array(out[0], pa.int32()),
                pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.int64())),
                pa.array(out[3], pa.list_(pa.string()))], names=["shard", "at", "begins", "ends", "items"])


def _longest(batches, shared):
    """Shards in; per test suffix whose window occurs its longest match in the shard and one place of it out."""
    items = shared.value
    for batch in batches:
        for number, vocabulary, tokens, suffixes, ids, sizes in zip(*(batch.column(i) for i in range(6))):
            sizes = np.array(sizes.as_py(), np.int64)
            found = Searcher(vocabulary.as_py(), tokens.as_py(), suffixes.as_py(), len(sizes), items)
            lo, hi = found.windows(items)
            starts = np.cumsum(sizes + 1) - (sizes + 1)
            rows = []
            for i in np.nonzero(lo < hi)[0]:
                n, a, b = found.longest(int(items.at[i]), int(lo[i]), int(hi[i]), int(items.need[i]), int(items.end[i]))
                p = int(found.sa[a:b].min())
                doc = int(np.searchsorted(starts, p, side="right") - 1)
                rows.append((items.ids[items.item[i]], int(items.at[i] - items.start[i]), n, b - a, ids[doc].as_py(), p - int(starts[doc])))
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), ids.type.value_type if hasattr(ids.type, "value_type") else None, pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number.as_py()] * len(rows), pa.int64())] + [pa.array(c, t) for c, t in zip(cols, types)],
                names=["shard", "item_id", "item_at", "length", "places", "doc_id", "doc_at"])


def _passes(benchmark: DataFrame, window: int, id_col: str, text_col: str):
    """The test items, a bounded number of words at a time, as shared values for the tasks."""
    spark = benchmark.sparkSession
    src = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    longest = src.agg(F.max(F.octet_length("text"))).first()[0]
    if longest is None:
        return
    rows = max(1, PASS_WORDS // (int(longest) // 2 + 1))  # a word takes two bytes with its separator
    numbered = number_rows(src, [F.col("id"), F.col("text")], "_n")
    last = numbered.agg(F.max("_n")).first()[0]
    for at in range(0, last + 1, rows):
        held = numbered.where((F.col("_n") >= at) & (F.col("_n") < at + rows)).orderBy("_n").select("id", "text").collect()
        yield spark.sparkContext.broadcast(Items([r[0] for r in held], [r[1] for r in held], window))


def search(shards: DataFrame, benchmark: DataFrame, window: int = 10, item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """Documents with occurrences: shard, at (the document's place there), begins, ends, items."""
    schema = "shard long, at int, begins array<long>, ends array<long>, items array<string>"
    out = None
    for items in _passes(benchmark, window, item_id, item_text):
        with large_rows(shards.sparkSession):
            got = materialize(shards.select("shard", "words", "tokens", "suffixes", "sizes").mapInArrow(
                lambda it, items=items: _hits(it, items), schema))
        out = got if out is None else out.unionByName(got)
    return out if out is not None else shards.sparkSession.createDataFrame([], schema)


def matches(shards: DataFrame, benchmark: DataFrame, window: int = 10, item_id: str = "item_id",
            item_text: str = "text") -> DataFrame:
    """Longest verbatim match of every test suffix in every shard where its window occurs, with one place of it.

    item_id, item_at (word of the item), length, places (how many suffixes of
    the shard share it), doc_id, doc_at (word of the document).
    """
    kind = shards.schema["ids"].dataType.elementType.simpleString()
    schema = f"shard long, item_id string, item_at long, length long, places long, doc_id {kind}, doc_at long"
    out = None
    for items in _passes(benchmark, window, item_id, item_text):
        with large_rows(shards.sparkSession):
            got = materialize(shards.select("shard", "words", "tokens", "suffixes", "ids", "sizes").mapInArrow(
                lambda it, items=items: _longest(it, items), schema))
        out = got if out is None else out.unionByName(got)
    return out if out is not None else shards.sparkSession.createDataFrame([], schema)


def _covered(stretches: Column) -> Column:
    """Words in the union of sorted [begin, end) stretches."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(stretches, zero, lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), x["ends"] - F.greatest(x["begins"], acc["upto"]))).alias("n"),
        F.greatest(acc["upto"], x["ends"]).alias("upto")))["n"]


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = SHARD_WORDS,
           id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    shards = build(docs, shard_words, id_col, text_col)
    hits = search(shards, benchmark, window, item_id, item_text)
    hits = hits.groupBy("shard", "at").agg(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("begins", "ends")))).alias("stretches"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = hits.select("shard", "at", _covered(F.col("stretches")).alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"), F.concat_ws(",", "items").alias("names"))
    every = shards.select("shard", F.posexplode(F.arrays_zip("ids", "sizes")).alias("at", "d"))
    return every.join(hits, ["shard", "at"], "left").select(
        F.col("d.ids").alias("doc_id"), F.col("d.sizes").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0).cast("long")) > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, **kw) -> DataFrame:
    """``docs`` without the rows that hold a window of ``benchmark``; all columns stay.

    ``docs`` is written once with a key for every row, so rows of a repeated id
    are judged one by one.
    """
    kw.pop("id_col", None)  # rows are told apart by the key
    key = "_row_key"
    while key in docs.columns:
        key += "_"
    keyed = materialize(docs.withColumn(key, F.monotonically_increasing_id()))
    bad = report(keyed, benchmark, window, id_col=key, **kw).where("contaminated").select(F.col("doc_id").alias(key))
    return keyed.join(bad, key, "left_anti").select(*docs.columns)
