"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the ``k`` smallest distinct 48-bit hashes of a text's shingles.
Sketches of parts merge into the sketch of the whole (union, keep ``k``), so a
long text or a whole source can be sketched in pieces. From sketches:

- ``resemblance``: share of the union's ``k`` smallest hashes found in both;
- ``containment``: of one set in another, from resemblance and the counts;
- ``distinct``: number of distinct shingles, exact below ``k``, else
  ``(k - 1) / kth hash``.

A sketch of at most ``k`` hashes is the whole set and gives exact answers.
Text form: base64 of the hashes, ascending, 6 bytes each, big-endian.

Null or empty text: empty sketch. Two empty sketches are alike (1.0); an empty
and another one are not (0.0).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.shingles import shingle_set
from cadastra.operators.materialize import materialize

K = 256
SPACE = 1 << 48


def bottom_k(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of a set of 64-bit shingle hashes."""
    h = hashes >> np.uint64(16)
    if len(h) > 4 * k:
        h = np.partition(h, 2 * k)[: 2 * k + 1]
        if len(small := np.unique(h)) >= k:
            return small[:k]
        h = hashes >> np.uint64(16)
    return np.unique(h)[:k]


def sketch(text: str | None, k: int = K, words: int = 5) -> np.ndarray:
    return bottom_k(shingle_set(text, words), k)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:k] if max(len(a), len(b)) >= k else np.union1d(a, b)
    return len(np.intersect1d(np.intersect1d(a, b, True), union, True)) / len(union)


def distinct(a: np.ndarray, k: int = K) -> float:
    return float(len(a)) if len(a) < k else (k - 1) * SPACE / float(a[k - 1] + np.uint64(1))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first set that is in the second."""
    if len(a) == 0:
        return 1.0
    j, na, nb = resemblance(a, b, k), distinct(a, k), distinct(b, k)
    return min(1.0, j * (na + nb) / (1 + j) / na)


def to_text(a: np.ndarray) -> str:
    raw = a.astype(">u8").tobytes()
    return base64.b64encode(np.frombuffer(raw, np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(s), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 2:] = raw
    return out.reshape(-1).view(">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, k: int = K, words: int = 5, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (text form) of every row."""
    @F.pandas_udf("string")
    def one(texts: pd.Series) -> pd.Series:
        return pd.Series([to_text(sketch(t, k, words)) for t in texts], dtype=object)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       one(F.col(text_col).cast("string")).alias("fingerprint"))


# ---- fingerprints against an edited text and the next document ------------------------------


def edited(text: str, following: str) -> str:
    """The last ``len // 2`` characters replaced by the first as many (or all) of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows dealt by id into ranges (``part``); the first row of a range also goes, as ``guest``, to the end
    of the range before it (the first of all to the last range). Order: doc_id, nulls first, then text.

    Only those guests move twice. Ranges are cut at quantiles of the ids, so a
    range is as long as repeated ids make it.
    """
    spark = docs.sparkSession
    n = max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n)).first()[0] if n > 1 else []
    bounds = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        at = np.zeros(len(ids), np.int32)
        if known.any():
            at[known.to_numpy()] = np.searchsorted(bounds, ids[known].astype("int64").to_numpy(), side="left")
        return pd.Series(at)

    d = docs.withColumn("part", range_of("doc_id"))
    # the first row of every range: its smallest id, then the smallest text under that id
    low = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id"))
    firsts = materialize(d.groupBy("part").agg(low.alias("h")).select("part", F.col("h.doc_id").alias("_low")))
    heads = d.join(F.broadcast(firsts.withColumnRenamed("part", "_part")),  # as many rows as ranges
                   (F.col("part") == F.col("_part")) & F.col("doc_id").eqNullSafe(F.col("_low")))
    heads = heads.groupBy("part").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    heads = materialize(heads)  # one text for each range
    parts = [r[0] for r in heads.select("part").orderBy("part").collect()]  # as many numbers as ranges
    if not parts:
        return d.withColumn("guest", F.lit(False))
    before = F.create_map(*[F.lit(x) for i, p in enumerate(parts) for x in (p, parts[i - 1])])
    guests = heads.select("doc_id", "text", before[F.col("part")].alias("part"), F.lit(True).alias("guest"))
    last = parts[-1]
    # the wrapped-around guest of the last range must come last there, and so must every other guest
    both = d.select("doc_id", "text", "part", F.lit(False).alias("guest")).unionByName(guests)
    return both.repartitionByRange(len(parts), "part").sortWithinPartitions(
        F.col("part"), F.col("guest"), F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())


def _compare(batches, k: int, words: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, part, guest) in order in; a row per document once its next one is known."""
    held = None  # (doc_id, text, sketch)
    rows: list[tuple] = []

    def made():
        cols = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    for batch in batches:
        for doc_id, text, guest in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            text = text or ""
            now = sketch(text, k, words)
            if held is not None:
                name, before, own = held
                change = edited(before, text)
                other = sketch(change, k, words)
                rows.append((name, len(before), hashlib.sha256(change.encode()).hexdigest(), to_text(own),
                             to_text(other), resemblance(own, other, k), resemblance(own, now, k)))
            held = None if guest else (doc_id, text, now)
            if len(rows) >= 256:
                yield made()
                rows = []
    if rows:
        yield made()


def against_next(docs: DataFrame, k: int = K, words: int = 5, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, that of its edited text, and the likeness to both the edited text and the next row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return with_next(src).mapInArrow(
        lambda it: _compare(it, k, words),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double")
