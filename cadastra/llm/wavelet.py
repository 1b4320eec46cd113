"""Token ids in wavelet matrices, one compressed file per shard.

A shard holds the ids of consecutive documents (ascending doc_id). Its file is
a wavelet matrix: one bit-plane per bit of the largest id, the highest bit
first; each plane holds that bit of every token, tokens stably partitioned by
the bits before. Ranks are sampled every 512 bits. Without unpacking the ids,
the file answers

- ``access(i)``: the token at a position,
- ``rank(t, i)``: how often a token occurs before a position,
- ``select(t, k)``: where its k-th occurrence is,
- ``count(t)`` and ``decode(lo, hi)``.

Bytes of a file: ``WVM1``, then little-endian: uint64 tokens, uint32 planes,
and per plane uint64 zeros and the packed bits (8 tokens a byte, low bit
first); all after the magic compressed by zstd. Files are written by Spark as
rows of a Parquet table in the cluster's shared folder, with the documents
they hold, so a lost task leaves no half-written shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.running import range_bases
from cadastra.llm.tokens import encoder, slices
from cadastra.operators.materialize import materialize

MAGIC = b"WVM1"
SHARD_TOKENS = 1 << 20  # a shard is closed once it holds this many tokens
_STEP = 512


def _narrow(bits: int) -> type:
    """The integer type that ids of so many bits are moved about in."""
    return np.uint16 if bits <= 16 else np.uint32


class WaveletMatrix:
    """Rank/select structure over one shard's ids."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray]):
        self.n, self.zeros, self.planes = n, zeros, planes  # planes: packed bits
        pad = _STEP // 8
        self._ranks = []
        for bits in planes:
            blocks = np.zeros((len(bits) + pad - 1) // pad * pad, np.uint8)
            blocks[: len(bits)] = bits
            ones = np.bitwise_count(blocks).reshape(-1, pad).sum(axis=1, dtype=np.int64)
            self._ranks.append(np.r_[0, np.cumsum(ones)])

    # -- building and files

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        ids = np.asarray(ids, np.uint32)
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        ids = ids.astype(_narrow(depth))
        zeros, planes = [], []
        for level in range(depth - 1, -1, -1):
            bit = ids & ids.dtype.type(1 << level) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            zeros.append(len(ids) - int(np.count_nonzero(bit)))
            ids = np.concatenate([np.compress(~bit, ids), np.compress(bit, ids)])
        return cls(len(ids), zeros, planes)

    def to_bytes(self) -> bytes:
        body = [struct.pack("<QI", self.n, len(self.planes))]
        for z, bits in zip(self.zeros, self.planes):
            body += [struct.pack("<Q", z), bits.tobytes()]
        return MAGIC + zstandard.ZstdCompressor(level=1).compress(b"".join(body))

    @classmethod
    def from_bytes(cls, blob: bytes) -> "WaveletMatrix":
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        body = zstandard.ZstdDecompressor().decompress(blob[4:])
        n, depth = struct.unpack_from("<QI", body)
        size, at, zeros, planes = (n + 7) // 8, 12, [], []
        for _ in range(depth):
            zeros.append(struct.unpack_from("<Q", body, at)[0])
            planes.append(np.frombuffer(body, np.uint8, size, at + 8))
            at += 8 + size
        return cls(n, zeros, planes)

    # -- queries

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // _STEP
        lo, bits = block * _STEP // 8, self.planes[level]
        ones = int(self._ranks[level][block]) + int(np.bitwise_count(bits[lo : i >> 3]).sum())
        if i & 7:
            ones += (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
        return ones

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level, z in enumerate(self.zeros):
            one, ones = self._bit(level, i), self._ones(level, i)
            out = out << 1 | one
            i = z + ones if one else i - ones
        return out

    def _range(self, token: int, i: int) -> tuple[int, int] | None:
        """Where the occurrences of a token before position ``i`` stand after the last plane."""
        depth = len(self.planes)
        if token < 0 or token >> depth:
            return None
        lo, hi = 0, i
        for level, z in enumerate(self.zeros):
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (z + a, z + b) if token >> (depth - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        found = self._range(token, max(0, min(i, self.n)))
        return found[1] - found[0] if found else 0

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token."""
        found = self._range(token, self.n)
        if found is None or not 0 <= k < found[1] - found[0]:
            raise IndexError(k)
        at, depth = found[0] + k, len(self.planes)
        for level in range(depth - 1, -1, -1):
            one = token >> (depth - 1 - level) & 1
            target = at - self.zeros[level] if one else at
            lo, hi = target, self.n - 1  # the position holding this plane's target-th one (or zero)
            while lo < hi:
                mid = (lo + hi) // 2
                ones = self._ones(level, mid + 1)
                if (ones if one else mid + 1 - ones) > target:
                    hi = mid
                else:
                    lo = mid + 1
            at = lo
        return at

    def decode(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids at positions ``lo`` to ``hi`` (exclusive), all planes at once.

        For the whole file the stable partitions are undone from the last plane up.
        """
        if lo == 0 and hi in (None, self.n):
            out = np.zeros(self.n, _narrow(len(self.planes)))
            for level, (bits, z) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
                one = np.unpackbits(bits, count=self.n, bitorder="little").view(bool)
                up = np.empty_like(out)
                up[np.flatnonzero(~one)] = out[:z]
                up[np.flatnonzero(one)] = out[z:] | out.dtype.type(1 << level)
                out = up
            return out.astype(np.uint32)
        i = np.arange(lo, self.n if hi is None else hi)
        out = np.zeros(len(i), np.uint32)
        for bits, z in zip(self.planes, self.zeros):
            plane = np.unpackbits(bits, count=self.n, bitorder="little")
            ones = np.concatenate([np.zeros(1, np.int64), np.cumsum(plane, dtype=np.int64)])
            one = plane[i].astype(bool)
            out = out << np.uint32(1) | one
            i = np.where(one, z + ones[i], i - ones[i])
        return out


# ---- writing and reading shards with Spark -------------------------------------------------

SHARDS = "part int, shard int, file binary, doc_ids array<long>, ends array<long>, tokens long"


def _write(batches, path: str, end_id: int, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    enc, end = encoder(path), end_id.to_bytes(4, "little")
    part, shard = TaskContext.get().partitionId(), 0
    ids: list[bytes] = []
    doc_ids: list[int | None] = []
    ends: list[int] = []
    total = 0

    def close():
        matrix = WaveletMatrix.build(np.frombuffer(b"".join(ids), "<u4"))
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([matrix.to_bytes()], pa.binary()),
             pa.array([doc_ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())),
             pa.array([total], pa.int64())],
            names=["part", "shard", "file", "doc_ids", "ends", "tokens"])

    for batch in batches:
        names = batch.column(0).to_pylist()
        for at, some in slices(batch.column(1).to_pylist()):
            for k, blob in enumerate(enc.encode_many(some)):
                ids.append(blob + end)
                total += len(blob) // 4 + 1
                doc_ids.append(names[at + k])
                ends.append(total)
                if total >= shard_tokens:
                    yield close()
                    ids, doc_ids, ends, total, shard = [], [], [], 0, shard + 1
    if doc_ids:
        yield close()
    enc.end_task()


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode every text and write the shard files; returns a scan of the written shards.

    Documents are in ascending doc_id order over (part, shard): null ids first,
    rows of one id by their text. A null text is empty: only its end id.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = src.repartitionByRange(*by).sortWithinPartitions(*by)
    return materialize(ranged.mapInArrow(
        lambda it: _write(it, tokenizer_path, end_id, shard_tokens), SHARDS))


def _read(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, doc_ids, ends, base in zip(*(batch.column(i).to_pylist() for i in range(4))):
            ids = WaveletMatrix.from_bytes(file).decode().astype("<u4")
            ends = np.array(ends, np.int64)
            starts = np.r_[0, ends[:-1]]
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(base + starts), pa.array(ends - starts),
                 pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_shards(shards: DataFrame) -> DataFrame:
    """Documents read back from written shards: doc_id, start (over all shards), n_tokens, ids_crc32."""
    sums = shards.groupBy("part").agg(F.sum("tokens").alias("n"))
    bases = range_bases(sums, "part", "n")
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(shards.select("part", "shard", F.coalesce(F.sum("tokens").over(within), F.lit(0)).alias("_before"))
                         .join(bases, "part").select("part", "shard", (F.col("base") + F.col("_before")).alias("base")))
    return shards.join(starts, ["part", "shard"]).select("file", "doc_ids", "ends", "base").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long")
