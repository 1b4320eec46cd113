"""Packing by power-of-two decomposition.

A document of ``L`` tokens is cut into ``L // max_length`` pieces of the full
length and one piece per set bit of the rest, largest first. Every piece is a
sequence of its own: its length is a power of two, so nothing is padded and no
sequence crosses documents. Sequences are bucketed by length: they are
numbered with the longest first, so each length is one contiguous range of
``sequence_id`` and a batch of one length is a range scan.

Null text: only the end id. Null or repeated ids and repeated rows: every row
is cut on its own. Empty table: no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.running import number_rows, small_batches
from cadastra.llm.tokens import encoder, slices
from cadastra.operators.materialize import drop_table, materialize

MAX_LENGTH = 2048


def cuts(length: int, max_length: int = MAX_LENGTH) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``length`` tokens."""
    full, rest = divmod(length, max_length)
    out = [(i * max_length, max_length) for i in range(full)]
    at, size = full * max_length, max_length >> 1
    while rest:
        if rest & size:
            out.append((at, size))
            at += size
            rest -= size
        size >>= 1
    return out


def _pieces(batches, path: str, end_id: int, max_length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    end = end_id.to_bytes(4, "little")
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for at, some in slices(texts):
            source, start, length, crc, tokens, ids = [], [], [], [], [], []
            for k, blob in enumerate(enc.encode_many(some)):
                blob += end
                n = len(blob) // 4
                for a, b in cuts(n, max_length):
                    part = blob[4 * a : 4 * (a + b)]
                    source.append(at + k)
                    start.append(a)
                    length.append(b)
                    crc.append(zlib.crc32(part))
                    tokens.append(n)
                    ids.append(part if with_ids else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int32())), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(ids, pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
            pa.default_memory_pool().release_unused()  # Arrow keeps a slice's pieces otherwise, as much as the table holds
    enc.end_task()


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, max_length: int = MAX_LENGTH,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of all documents, each a sequence: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and (``with_ids``) ids, the piece's tokens as little-endian uint32.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = src.mapInArrow(
        lambda it: _pieces(it, tokenizer_path, end_id, max_length, with_ids),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
    if not with_ids:
        pieces = pieces.drop("ids")
    with small_batches(docs.sparkSession):
        pieces = materialize(pieces)  # numbering reads its input twice; texts are encoded once
    order = [F.col("length").desc(), F.col("doc_id").asc(), F.col("start").asc(), F.col("ids_crc32").asc()]
    out = number_rows(pieces, order, "sequence_id").withColumn("offset", F.lit(0).cast("long"))
    drop_table(pieces)  # the numbered rows are a table of their own
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*cols, *(["ids"] if with_ids else []))
