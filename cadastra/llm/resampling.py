"""Quality selection by importance resampling of hashed n-grams.

Two bags of hashed n-grams are counted: the target's (documents labelled good)
and the raw text's (all documents). A document's log weight is the sum over
its n-grams of ``log p_target - log p_raw``, less an offset per n-gram, plus a
prior. Gumbel noise is added and the ``k`` largest sums are kept, which is
sampling ``k`` documents without replacement in proportion to their weights.

The offset is calibrated on held-out labels so that the weight is positive
for text like the good half and negative for text like the bad half; ``k`` is
the number of documents whose weight is at least 0, so the size of the sample
follows the data. The prior keeps texts too short to judge.

N-grams: words and marks (``\\w+`` or a run of other characters), lower-cased,
alone and in pairs, and pairs and triples of their shapes (capitals, digits,
marks). Only labels are bounded (``max_labels``); raw counts cover every
document.

Null or empty text: no n-grams, weight = the prior: kept. No good label: the
weights are all the prior and everything is kept. Labels naming no document,
null or repeated labels (any good label makes a row good) are fine. Rows equal
in id and text get equal noise, so they are kept or rejected together; all
rows that tie with the k-th are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.running import small_batches
from cadastra.llm.shingles import mix64
from cadastra.operators.materialize import materialize

BUCKET_BITS = 13
WORD_CACHE = 100_000  # tokens whose hash a Python worker keeps
MAX_LABELS = 20_000
PRIOR = 6.0
SMOOTHING = 0.5
CLIP = 6.0
SEED = 17
OFFSETS = np.linspace(-2.0, 0.2, 221)
FALSE_REJECT_COST = 50.0  # a good document lost, against a bad one kept

_TOKEN = re.compile(r"\w+|[^\w\s]+")


def _shape(token: str) -> int:
    if token.isalpha():
        return 1 if token.islower() else 2 if token.isupper() and len(token) > 1 else 3 if token[0].isupper() else 4
    if token.isdigit():
        return 5
    if token.isalnum():
        return 6
    return 16 + xxhash.xxh3_64_intdigest(token[:2].encode("utf-8", "surrogatepass")) % 200


class _Tokens(dict):
    """token -> 56 bits of hash of its lower-cased form, 8 bits of shape."""

    def __missing__(self, token: str) -> int:
        h = xxhash.xxh3_64_intdigest(token.lower().encode("utf-8", "surrogatepass"))
        v = (h & ~0xFF) | _shape(token)
        if len(self) < WORD_CACHE:
            self[token] = v
        return v


_TOKENS = _Tokens()
_K = np.uint64(0x9E3779B97F4A7C15)


def buckets(text: str | None) -> np.ndarray:
    """Bucket of every n-gram of a text, with repeats."""
    found = _TOKEN.findall(text or "")
    v = np.fromiter(map(_TOKENS.__getitem__, found), np.uint64, len(found))
    shape, word = v & np.uint64(0xFF), v >> np.uint64(8)
    grams = [word, word[:-1] * _K + word[1:] + np.uint64(1)]
    s2 = (shape[:-1] << np.uint64(8)) | shape[1:]
    grams += [s2 + np.uint64(1 << 60), ((s2[:-1] << np.uint64(8)) | shape[2:]) + np.uint64(1 << 61)]
    return (mix64(np.concatenate(grams)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _count(batches) -> Iterator[pa.RecordBatch]:
    """(text, is_target) in; counts per bucket of the raw text and of the target out."""
    total = np.zeros((2, 1 << BUCKET_BITS), np.int64)
    for batch in batches:
        for text, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            c = np.bincount(buckets(text), minlength=total.shape[1])
            total[0] += c
            if target:
                total[1] += c
    at = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])],
                                     names=["bucket", "raw", "target"])


@dataclass(frozen=True)
class Weights:
    """A fitted ratio: one log ratio per bucket, and the offset taken off each n-gram."""

    log_ratio: np.ndarray
    offset: float
    prior: float = PRIOR

    def weigh(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Log weight and number of n-grams of each text."""
        n, w = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.float64)
        for i, t in enumerate(texts):  # text by text: the n-grams of one text are in memory at once
            found = buckets(t)
            n[i], w[i] = len(found), self.log_ratio[found].sum()
        return np.round(self.prior + w - self.offset * n, 9), n

    def column(self, text: Column) -> Column:
        """Struct (log_weight, n_grams) of a text column."""
        weights = self

        @F.pandas_udf("log_weight double, n_grams long")
        def weigh(texts: pd.Series) -> pd.DataFrame:
            w, n = weights.weigh(texts)
            return pd.DataFrame({"log_weight": w, "n_grams": n})

        return weigh(text)


def _labelled(labels: DataFrame, max_labels: int) -> DataFrame:
    one = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("_label_id")).agg(F.max("quality").alias("_quality"))
    # at most max_labels rows of two numbers: a proven bound for the broadcast
    return one.orderBy(F.xxhash64("_label_id"), "_label_id").limit(max_labels)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_labels: int = MAX_LABELS) -> Weights:
    """Count target and raw n-grams, then calibrate the offset on the other half of the labels."""
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    lab = F.broadcast(materialize(_labelled(labels, max_labels)))
    fitted = F.pmod(F.xxhash64("_label_id", F.lit(1)), F.lit(2)) == 0
    both = src.join(lab, src["_id"] == lab["_label_id"], "left")
    rows = both.select("text", F.coalesce(fitted & (F.col("_quality") > 0), F.lit(False)).alias("target"))
    sums = rows.mapInArrow(_count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw"), F.sum("target")).collect()  # at most 2**BUCKET_BITS rows
    counts = np.zeros((2, 1 << BUCKET_BITS))
    for b, raw, target in sums:
        counts[:, b] = raw, target
    if counts[1].sum() == 0:
        return Weights(np.zeros(1 << BUCKET_BITS), 0.0)
    p = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * counts.shape[1])
    ratio = np.clip(np.log(p[1]) - np.log(p[0]), -CLIP, CLIP)
    plain = Weights(ratio, 0.0, 0.0)
    held = src.join(lab, src["_id"] == lab["_label_id"]).where(~fitted).select("_quality", "text")
    # weighed and counted by one Python worker: two Python steps in a row are two workers a task, and idle ones stay
    sums = held.mapInArrow(lambda it: _misjudged(it, plain), "good boolean, at int, n long, wrong long").groupBy("good", "at").agg(
        F.sum("n"), F.sum("wrong")).collect()  # at most two rows an offset of the grid, over every held-out row
    return Weights(ratio, _offset(sums))


def _misjudged(batches, weights: Weights) -> Iterator[pa.RecordBatch]:
    """(quality, text) of held-out rows in; per kind and offset the rows and the misjudged ones out."""
    n, wrong = np.zeros(2, np.int64), np.zeros((2, len(OFFSETS)), np.int64)
    for batch in batches:
        good = batch.column(0).to_numpy(zero_copy_only=False) > 0
        w, grams = weights.weigh(batch.column(1).to_pylist())
        n += np.bincount(good.astype(np.int64), minlength=2)
        for i, t in enumerate(OFFSETS):
            rejected = PRIOR + w - t * grams < 0
            wrong[0, i] += np.count_nonzero(~rejected & ~good)
            wrong[1, i] += np.count_nonzero(rejected & good)
    for kind in np.flatnonzero(n):
        yield pa.RecordBatch.from_arrays(
            [pa.array([bool(kind)] * len(OFFSETS)), pa.array(range(len(OFFSETS)), pa.int32()),
             pa.array([int(n[kind])] * len(OFFSETS), pa.int64()), pa.array(wrong[kind])], names=["good", "at", "n", "wrong"])


def _offset(sums) -> float:
    """Offset with the least cost on held-out labels; the middle of the best ones, -0.25 without both kinds."""
    share = np.full((2, len(OFFSETS)), np.nan)
    for good, at, n, wrong in sums:
        share[int(good), at] = wrong / n
    if np.isnan(share).any():
        return -0.25
    cost = FALSE_REJECT_COST * share[1] + share[0]
    return float(np.median(OFFSETS[cost <= cost.min() + 1e-12]))


def sample_key(weight: Column, *identity: Column, seed: int = SEED) -> Column:
    """log weight + standard Gumbel noise drawn from a hash of the row's identity."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11)
    u = (bits + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.round(weight - F.log(-F.log(u)), 9)


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column of doubles (to 2**-30), by counting in 4,096 cells a round."""
    if k <= 0:
        return None
    unit = float(1 << 30)
    x = df.select(F.floor(F.col(column) * unit).cast("long").alias("x"))
    lo, hi = x.agg(F.min("x"), F.max("x")).first()
    if lo is None:
        return None
    while hi > lo:
        width = (hi - lo) // 4096 + 1
        cells = dict(x.where(F.col("x").between(lo, hi)).groupBy(
            F.floor((F.col("x") - lo) / width).cast("long").alias("c")).count().collect())
        for c in sorted(cells, reverse=True):
            if k <= cells[c]:
                break
            k -= cells[c]
        lo, hi = lo + c * width, min(hi, lo + (c + 1) * width - 1)
    return lo / unit


@dataclass(frozen=True)
class Selection:
    weights: Weights
    threshold: float | None
    scored: DataFrame  # doc_id, text_hash, n_grams, log_weight, sample_key of every row, written

    def selected(self) -> Column:
        return F.lit(True) if self.threshold is None else F.col("sample_key") >= self.threshold


def select(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Selection:
    """Fit, weigh every row and find the k-th largest key."""
    with small_batches(docs.sparkSession):
        return _select(docs, labels, id_col, text_col)


def _select(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> Selection:
    weights = fit(docs, labels, id_col, text_col)
    text, doc_id = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    scored = docs.select(doc_id.alias("doc_id"), weights.column(text).alias("w"),
                         F.xxhash64(text).alias("t")).select(
        "doc_id", F.col("t").alias("text_hash"), "w.n_grams", "w.log_weight", sample_key(F.col("w.log_weight"), F.col("doc_id"), F.col("t")).alias("sample_key"))
    scored = materialize(scored)
    k = scored.where("log_weight >= 0").count()
    return Selection(weights, kth_largest(scored, "sample_key", k), scored)


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the sample keeps, all columns as they were."""
    s = select(docs, labels)
    # rows of one id and one text have one key, so the written keys decide and no text is weighed again
    kept = s.scored.where(s.selected()).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_t")).distinct()
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    mine = F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_id"))
    return d.join(kept, mine & (F.xxhash64(F.col("_row.text").cast("string")) == F.col("_t")), "left_semi").select("_row.*")
