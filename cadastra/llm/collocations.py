"""Phrase collocation mining with sorted count streams.

The layout is that of external language-model estimation: count streams lie in
prefix order and in suffix order, and all counts that belong together are
found by reading sorted streams in step. Nothing is looked up in a hash table
of counts.

1. *Runs.* A task reads texts until it holds ``CHUNK_WORDS`` words, forms the
   window of up to ``max_words`` words that begins at every word (a window ends
   with its piece), sorts the windows by (lang, words) in byte order, and
   collapses equal ones into one with a count. The sorted run is cut at the
   global cut points into ranges.
2. *Merge.* The runs of one range are merged into one stream in prefix order.
   A phrase of ``n`` words is a stretch of windows that share their first ``n``
   words, so one reading of the stream counts the phrases of every length.
   Only the stretches at the two ends of a range can go on in another range:
   their partial counts are added up afterwards. A cut point is a whole window,
   so a very common word, or word pair, is spread over as many ranges as it
   fills, and equal windows have collapsed before they travel.
3. *Suffix order.* Phrases with at least ``min_count`` occurrences (every part
   of such a phrase is one) are sorted by their words from the last to the
   first. A phrase then follows all its suffixes: one scan gives each phrase
   the counts of its suffixes, and each suffix the largest count among the
   phrases that are longer by one word on the left.
4. *Prefix order.* The same scan over the words from first to last gives the
   counts of the prefixes and the largest right extension.

A phrase inside a longer one has a neighbour longer by one word with at least
that count, so the two extension counts decide the containment rule.

The cut points come from a sample of windows; they balance the ranges and have
no effect on results. Scores and the containment rule are computed on decimals
of 38 digits.

Null texts are empty, a null language is ``und`` (and counts with the language
of that name). Repeated rows count as often as they stand there. Empty tables
give no rows. Columns other than the text and the language are not read. A
text is read whole; a task needs memory for its longest text beside a chunk.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.materialize import materialize

CHUNK_WORDS = 1 << 20
RANGE_BYTES = 12 << 20  # text whose windows one range holds, about two million words
MAX_RANGES = 1 << 14
SAMPLE_STEP = 32  # every such window of a sampled text
SAMPLES_PER_RANGE = 64
_BREAK = b"\xff"  # no byte of UTF-8
_PIECES = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", _BREAK * 10 + b" ")


def tokens(text: str | None) -> list[bytes]:
    """Words of a text with ``A-Z`` lower-cased; a break byte between its pieces."""
    data = (text or "").encode("utf-8", "surrogatepass").lower().translate(_PIECES)
    return data.replace(_BREAK, b" \xff ").split()


def _windows(ids: np.ndarray, size: int) -> list[np.ndarray]:
    """Word ``k`` of the window at every position; 0 beyond the end of a piece."""
    out = [ids]
    for k in range(1, size):
        nxt = np.zeros_like(ids)
        nxt[: len(ids) - k] = ids[k:]
        out.append(np.where(out[-1] > 0, nxt, 0))
    return out


class _Chunk:
    """Texts gathered into one sorted run."""

    def __init__(self, size: int):
        self.size = size
        self.numbers = defaultdict(count(1).__next__)
        self.langs = defaultdict(count().__next__)
        self.ids, self.lang, self.lengths, self.held = [], [], [], 0

    def add(self, lang: str, text: str | None):
        t = tokens(text)
        if not t:
            return
        t.append(_BREAK)
        get = self.numbers.__getitem__
        self.ids.append(np.fromiter(map(get, t), np.int32, len(t)))
        self.lang.append(self.langs[lang.encode("utf-8", "surrogatepass")])
        self.lengths.append(len(t))
        self.held += len(t)

    def run(self):
        """(langs, words, columns, counts): the sorted distinct windows; column 0 is the language."""
        words = sorted(w for w in self.numbers if w != _BREAK)
        rank = np.zeros(len(self.numbers) + 1, np.int32)
        rank[[self.numbers[w] for w in words]] = np.arange(1, len(words) + 1)
        ids = rank[np.concatenate(self.ids)]
        langs = sorted(self.langs)
        lang_rank = np.empty(len(langs), np.int32)
        lang_rank[[self.langs[x] for x in langs]] = np.arange(len(langs))
        lang = np.repeat(lang_rank[self.lang], self.lengths)
        cols = _windows(ids, self.size)
        real = ids > 0
        cols = [lang[real]] + [c[real] for c in cols]
        cols, counts = collapse(cols, np.ones(len(cols[0]), np.int64))
        return langs, words, cols, counts


def _keys(cols: list[np.ndarray]) -> list[np.ndarray]:
    """The columns packed into as few 64-bit keys as their sizes allow, most important first."""
    keys, room = [], 0
    for c in cols:
        bits = max(1, int(c.max(initial=0)).bit_length())
        if keys and room >= bits:
            keys[-1] <<= bits
            keys[-1] |= c
            room -= bits
        else:
            keys.append(c.astype(np.int64))
            room = 62 - bits
    return keys


def collapse(cols: list[np.ndarray], counts: np.ndarray):
    """Rows sorted by their columns; equal rows become one, their counts added."""
    if not len(counts):
        return cols, counts
    order = np.lexsort(_keys(cols)[::-1])
    cols = [c[order] for c in cols]
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    at = np.nonzero(new)[0]
    return [c[at] for c in cols], np.add.reduceat(counts[order], at)


def _place(cut: tuple, langs: list[bytes], words: list[bytes], cols: list[np.ndarray]) -> int:
    """Number of rows before a cut point; ``cut`` is (lang, word, ...), shorter windows end early."""
    lo, hi = 0, len(cols[0])
    for k, value in enumerate(cut):
        names, shift = (langs, 0) if k == 0 else (words, 1)
        n = bisect_left(names, value)
        known = n < len(names) and names[n] == value
        n += shift
        left = lo + int(np.searchsorted(cols[k][lo:hi], n))
        if not known:
            return left
        lo, hi = left, lo + int(np.searchsorted(cols[k][lo:hi], n, side="right"))
    return lo


def _encode(langs, words, cols, counts) -> tuple:
    used = np.unique(np.concatenate(cols[1:]))
    used = used[used > 0]
    new = np.zeros(len(words) + 1, np.uint32)
    new[used] = np.arange(1, len(used) + 1)
    lang_used, lang = np.unique(cols[0], return_inverse=True)
    body = b"".join([lang.astype("<u4").tobytes(), *(new[c].tobytes() for c in cols[1:]), counts.astype("<u8").tobytes()])
    return ([langs[i] for i in lang_used], b"\n".join([words[i - 1] for i in used]), len(counts),
            zstandard.ZstdCompressor(level=1).compress(body))


def _decode(size: int, n: int, body: bytes):
    raw = zstandard.ZstdDecompressor().decompress(body)
    cols = [np.frombuffer(raw, "<i4", n, 4 * n * k) for k in range(size + 1)]
    return cols, np.frombuffer(raw, "<u8", n, 4 * n * (size + 1)).astype(np.int64)


def _runs(batches, shared, size: int, chunk_words: int):
    """(lang, text) in; the runs' pieces by range out."""
    cuts = shared.value

    def pieces(chunk):
        langs, words, cols, counts = chunk.run()
        at = [0] + [_place(c, langs, words, cols) for c in cuts] + [len(counts)]
        rows = []
        for r, (a, b) in enumerate(zip(at, at[1:])):
            if a < b:
                rows.append((r, *_encode(langs, words, [c[a:b] for c in cols], counts[a:b])))
        for i in range(0, len(rows), 64):
            c = list(zip(*rows[i : i + 64]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int32()), pa.array(c[1], pa.list_(pa.binary())), pa.array(c[2], pa.binary()),
                 pa.array(c[3], pa.int32()), pa.array(c[4], pa.binary())], names=["range", "langs", "words", "n", "body"])

    chunk = _Chunk(size)
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            chunk.add(lang.as_py(), text.as_py())
            if chunk.held >= chunk_words:
                yield from pieces(chunk)
                chunk = _Chunk(size)
    if chunk.held:
        yield from pieces(chunk)


def _merged(parts: list[tuple], size: int):
    """Pieces of one range as one sorted stream."""
    words = sorted(set().union(*(p[1].split(b"\n") if p[1] else () for p in parts)))
    langs = sorted(set().union(*(p[0] for p in parts)))
    rank = {w: i for i, w in enumerate(words, 1)}
    lang_rank = {w: i for i, w in enumerate(langs)}
    total, at = sum(p[2] for p in parts), 0
    cols, counts = [np.empty(total, np.int32) for _ in range(size + 1)], np.empty(total, np.int64)
    while parts:  # a piece is dropped once its rows are in place
        own_langs, own_words, n, body = parts.pop()
        own, counts[at : at + n] = _decode(size, n, body)
        to = np.array([0] + [rank[w] for w in own_words.split(b"\n")], np.int32)
        cols[0][at : at + n] = np.array([lang_rank[x] for x in own_langs], np.int32)[own[0]]
        for c, x in zip(cols[1:], own[1:]):
            c[at : at + n] = to[x]
        at += n
    return langs, words, *collapse(cols, counts)


def stretches(langs, words, cols, counts, size: int, min_count: int):
    """Phrases of every length in a sorted stream: (lang, n, words, count, open).

    Closed stretches below ``min_count`` are left out; open ones reach an end
    of the stream and may go on in the next. ``n`` = 0 is the language itself.
    """
    new = np.zeros(len(counts), bool)
    new[0] = True
    for n in range(size + 1):
        new[1:] |= cols[n][1:] != cols[n][:-1]
        at = np.nonzero(new)[0]
        total = np.add.reduceat(counts, at)
        is_open = np.zeros(len(at), bool)
        is_open[[0, -1]] = True
        if n == 0:
            is_open[:] = True
        keep = np.nonzero((is_open | (total >= min_count)) & (cols[n][at] > 0 if n else True))[0]
        for i in keep:
            row = at[i]
            yield (langs[cols[0][row]].decode("utf-8", "surrogatepass"), n,
                   [words[cols[k][row] - 1].decode("utf-8", "surrogatepass") for k in range(1, n + 1)],
                   int(total[i]), bool(is_open[i]))


def _count(batches, size: int, min_count: int):
    """Pieces sorted by range in; phrases with their counts out."""
    def done(parts):
        rows = list(stretches(*_merged(parts, size), size, min_count))
        for i in range(0, len(rows), 20_000):
            c = list(zip(*rows[i : i + 20_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.string()), pa.array(c[1], pa.int32()), pa.array(c[2], pa.list_(pa.string())),
                 pa.array(c[3], pa.int64()), pa.array(c[4], pa.bool_())], names=["lang", "n", "words", "f", "open"])

    now, parts = None, []
    for batch in batches:
        for r, langs, words, n, body in zip(*(batch.column(i) for i in range(5))):
            if r.as_py() != now and parts:
                yield from done(parts)
                parts = []
            now = r.as_py()
            parts.append((langs.as_py(), words.as_py(), n.as_py(), body.as_py()))
    if parts:
        yield from done(parts)


def _sample(batches, size: int):
    for batch in batches:
        out = []
        for lang, text in zip(batch.column(0), batch.column(1)):
            t = tokens(text.as_py())
            for i in range(0, len(t), SAMPLE_STEP):
                if t[i] != _BREAK:
                    w = t[i : i + size]
                    out.append([lang.as_py().encode("utf-8", "surrogatepass")] + (w[: w.index(_BREAK)] if _BREAK in w else w))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.binary()))], names=["w"])


def _cuts(src: DataFrame, size: int, range_bytes: int) -> list[tuple]:
    """Cut points between ranges of about equal size: at most ``MAX_RANGES`` windows."""
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(MAX_RANGES, -(-total // range_bytes))
    if ranges < 2:
        return []
    share = min(1.0, ranges * SAMPLES_PER_RANGE * SAMPLE_STEP * 6 / total)  # a word is about six bytes
    rows = src.where(F.rand(17) < share).mapInArrow(lambda it: _sample(it, size), "w array<binary>").collect()
    seen = sorted(tuple(bytes(x) for x in r[0]) for r in rows)
    return sorted({seen[i * len(seen) // ranges] for i in range(1, ranges)}) if seen else []


def counts(docs: DataFrame, max_words: int = 4, min_count: int = 30, lang_col: str = "lang", text_col: str = "text",
           range_bytes: int = RANGE_BYTES, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Phrases of up to ``max_words`` words with at least ``min_count`` occurrences: lang, n, words, f.

    Rows with ``n`` = 0 hold the number of words of each language, however small.
    """
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    cuts = _cuts(src, max_words, range_bytes)
    shared = spark.sparkContext.broadcast(cuts)
    runs = src.mapInArrow(lambda it: _runs(it, shared, max_words, chunk_words),
                          "range int, langs array<binary>, words binary, n int, body binary")
    streams = runs.repartitionById(len(cuts) + 1, "range").sortWithinPartitions("range")  # a range is a partition
    every = materialize(streams.mapInArrow(lambda it: _count(it, max_words, min_count),
                                           "lang string, n int, words array<string>, f long, open boolean"))
    joined = every.where("open").groupBy("lang", "n", "words").agg(F.sum("f").alias("f")).where(
        (F.col("f") >= min_count) | (F.col("n") == 0))
    return materialize(every.where("NOT open").select("lang", "n", "words", "f").unionByName(joined))


def _scan(batches, tag: str, size: int):
    """One stream in (lang, key) order in; every phrase with the counts of its heads and its best extension out.

    ``{tag}1`` .. are the counts of the heads of 1, 2, ... words in this order,
    ``{tag}x`` the largest count among the phrases longer by one word. All heads
    of a phrase stand before it; the phrases on the path to the last row stay
    back until the next batch, since their extensions may go on.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        zeros = pa.array(np.zeros(batch.num_rows, np.int64))
        for name in [f"{tag}{k}" for k in range(1, size)] + [f"{tag}x"]:
            t = t.append_column(name, zeros)
        if held is not None:
            t = pa.concat_tables([held, t])
        n, f = t.column("n").to_numpy(), t.column("f").to_numpy()
        rows = np.arange(len(n))
        last = [np.maximum.accumulate(np.where(n == k, rows, -1)) for k in range(1, size)]
        ext = t.column(f"{tag}x").to_numpy().copy()
        for k in range(1, size):
            longer = n == k + 1
            np.maximum.at(ext, last[k - 1][longer], f[longer])
            head = np.where(n > k, f[last[k - 1]], 0)
            t = t.set_column(t.schema.get_field_index(f"{tag}{k}"), f"{tag}{k}", pa.array(head))
        t = t.set_column(t.schema.get_field_index(f"{tag}x"), f"{tag}x", pa.array(ext))
        path = [int(last[k - 1][-1]) for k in range(1, int(n[-1]))] + [len(n) - 1]
        stay = np.zeros(len(n), bool)
        stay[path] = True
        held = t.filter(pa.array(stay))
        yield from t.filter(pa.array(~stay)).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def in_step(stream: DataFrame, key: Column, tag: str, max_words: int) -> DataFrame:
    """Read ``stream`` (lang, n, words, f) in the order of ``key`` and attach head counts and extensions.

    Ranges are cut between first words, so a range holds all phrases that begin
    with a word: distinct frequent phrases, read as a stream and never held.
    """
    # the first word leads the order; a phrase follows its heads since a shorter array sorts first
    ordered = stream.withColumn("_key", key).withColumn("_first", F.element_at("_key", 1))
    ordered = ordered.repartitionByRange("lang", "_first").sortWithinPartitions("lang", "_key").drop("_key", "_first")
    added = ", ".join([f"{tag}{k} long" for k in range(1, max_words)] + [f"{tag}x long"])
    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in ordered.schema) + ", " + added
    return ordered.mapInArrow(lambda it: _scan(it, tag, max_words), schema)


def collocations(docs: DataFrame, max_words: int = 4, min_count: int = 30, top: int = 2000, lang_col: str = "lang",
                 text_col: str = "text", **sizes) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    every = counts(docs, max_words, min_count, lang_col, text_col, **sizes)
    totals = every.where("n = 0").select("lang", F.col("f").alias("_n"))
    phrases = every.where("n > 0")
    suffix = materialize(in_step(phrases, F.reverse("words"), "s", max_words))  # written in suffix order
    both = in_step(suffix, F.col("words"), "p", max_words)
    wide = "decimal(20,0)"
    cuts = [
        F.when(F.col("n") > k, F.struct(
            F.floor(F.lit(2000000).cast(wide) * F.col("f").cast(wide) / (left + right).cast(wide)).cast("long").alias("score"),
            F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
        for k in range(1, max_words)
        for left in [F.col(f"p{k}")]
        for right in [F.coalesce(*[F.when(F.col("n") == n, F.col(f"s{n - k}")) for n in range(k + 1, max_words + 1)])]
    ]
    scored = both.where("n > 1").withColumn("_c", F.array_min(F.array_compact(F.array(*cuts))))
    longer = F.greatest("sx", "px").cast(wide) * F.lit(100)
    kept = scored.where((F.col("n") == max_words) | (longer < F.col("f").cast(wide) * F.lit(80))).select(
        "lang", F.concat_ws(" ", "words").alias("phrase"), F.col("f").alias("a"), "_c.l", "_c.r", "_c.score")
    # ranked in two steps: no task orders all phrases of a language, only the best ``top`` of each part of it
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = some.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_r") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("_n").alias("n"), "score")
