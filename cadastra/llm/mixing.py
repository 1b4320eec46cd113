"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every source has a target number of words. It is met by whole passes over the
source (epochs) and one fractional pass: documents get the key
``-ln(u) / quality``, the smallest keys come first, and documents are taken in
that order until their words fill the rest of the target; the document at the
edge is taken if that brings the total nearer.

``u`` is a hash of the seed and the doc_id, so reruns agree. Rows with the same
key (repeated rows) are taken or left together. No window spans a source:
keys are cut into cells, cells are summed, and only the cell at the edge is
ordered document by document.

Null text: size 0, never adds words. Null source: a source of its own, last in
order. Null ids share one draw. Empty table: no rows. An all-empty table has
targets of 0. Extra columns are kept out of the way (``apply`` returns the
input columns only).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.materialize import materialize

SEED = 23
MAX_PASSES = 3
CELL_ROWS = 2000  # documents of one cell of keys, about
# a word with the white space before it, or white space after the last word; the group is the word's first character
WORD = r"[\x20\x09-\x0D]*+([^\x20\x09-\x0D])[^\x20\x09-\x0D]*+|[\x20\x09-\x0D]++"


def n_words(text: Column) -> Column:
    """Words of a text: one character of each stays and is counted (``regexp_count`` would build a list of all words)."""
    return F.coalesce(F.length(F.regexp_replace(text, WORD, "$1")), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Default quality weight: 0.05 and up to 0.95 more by the share of letters and spaces."""
    kept = F.length(F.regexp_replace(text, r"[^\p{L} ]++", ""))
    share = F.try_divide(kept, F.length(text))
    return F.lit(0.05) + F.lit(0.95) * F.coalesce(share, F.lit(0.0))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """Uniform in (0, 1) from the id: 52 bits of a digest."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def keyed(docs: DataFrame, quality: Column | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, source, size and sampling key of every row."""
    text = F.col("text").cast("string")
    q = letter_share(text) if quality is None else quality
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        n_words(text).alias("size"), (-F.log(draw(F.col("doc_id"), seed)) / q).alias("key"))


def targets(sizes: DataFrame, max_passes: int = MAX_PASSES) -> DataFrame:
    """Adds ``target`` to (source, source_size, ...): one row per source.

    Weights 1, 2, 3 repeat over the sources in order. All words are shared by
    weight; a source stops at ``max_passes`` times its size and the excess is
    shared again, until none is above. Sources sorted by cap over weight reach
    their caps in that order, so the final share per weight is found by running
    sums over the (few) sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("_w", (F.row_number().over(by_name) - 1) % 3 + 1)
    s = s.withColumn("_cap", max_passes * F.col("source_size")).withColumn("_r", F.col("_cap") / F.col("_w"))
    order = [F.col("_r"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumn("_i", F.row_number().over(Window.orderBy(*order)))
    s = s.withColumn("_share", (
        F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0))))
    first = F.min(F.when(F.col("_share") <= F.col("_r"), F.struct("_i", "_share"))).over(every)
    s = s.withColumn("_first", first)
    return s.withColumn("target", F.least(
        F.col("_cap").cast("double"), F.coalesce(F.col("_first._share"), F.lit(0.0)) * F.col("_w"))
    ).drop("_w", "_cap", "_r", "_i", "_share", "_first")


def _cell(key: Column, cells: Column) -> Column:
    return F.floor((1 - F.exp(-key)) * cells).cast("long")


@dataclass(frozen=True)
class Mix:
    """Per source: source_size, target, epochs, cells, and the edge (cell and key) of the fractional pass."""

    sources: DataFrame

    def join(self, rows: DataFrame, source: Column) -> DataFrame:
        s = self.sources.withColumnRenamed("source", "_source")
        return rows.join(s, source.eqNullSafe(s["_source"]), "left").drop("_source")

    @staticmethod
    def copies(key: Column) -> Column:
        """How often a row is taken, on rows joined with the sources."""
        cell = _cell(key, F.col("cells"))
        inside = (cell < F.col("edge_cell")) | ((cell == F.col("edge_cell")) & (key <= F.col("edge_key")))
        return F.col("epochs") + F.coalesce(inside, F.lit(False)).cast("long")


def plan(rows: DataFrame) -> Mix:
    """Targets, epochs and edges from the output of ``keyed`` (read three times: write it first)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    s = targets(sizes)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    s = s.withColumn("epochs", epochs.cast("long"))
    s = materialize(s.withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn(
        "cells", F.ceil(F.col("_rows") / CELL_ROWS).cast("long")))
    small = s.select(F.col("source").alias("_source"), "_rest", "cells")
    celled = rows.join(small, rows.source.eqNullSafe(small["_source"])).select(
        "source", "size", "key", "_rest", _cell(F.col("key"), F.col("cells")).alias("cell")).where("_rest > 0")
    sums = celled.groupBy("source", "cell").agg(F.sum("size").alias("_sum"), F.first("_rest").alias("_rest"))
    run = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_to", F.sum("_sum").over(run))
    edge = materialize(sums.where("_to - _sum < _rest AND _to >= _rest").select(
        F.col("source").alias("_s"), F.col("cell").alias("_c"), (F.col("_to") - F.col("_sum")).alias("_from")))
    near = celled.join(edge, celled.source.eqNullSafe(edge["_s"]) & (celled.cell == edge["_c"])).groupBy(
        "source", "cell", "key").agg(F.sum("size").alias("_sum"), F.first("_rest").alias("_rest"),
                                     F.first("_from").alias("_from"))
    run = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_to", F.col("_from") + F.sum("_sum").over(run))
    before = F.col("_to") - F.col("_sum")
    taken = (F.col("_to") <= F.col("_rest")) | (
        (before < F.col("_rest")) & (F.col("_to") - F.col("_rest") <= F.col("_rest") - before))
    keys = near.groupBy("source", "cell").agg(
        F.coalesce(F.max(F.when(taken, F.col("key"))), F.lit(-1.0)).alias("edge_key"))
    keys = keys.select(F.col("source").alias("_s"), F.col("cell").alias("edge_cell"), "edge_key")
    out = s.join(keys, s.source.eqNullSafe(keys["_s"]), "left").select(
        "source", "source_size", "target", "epochs", "cells", "edge_cell", "edge_key")
    return Mix(materialize(out))


def mix(docs: DataFrame, quality: Column | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes) of every row."""
    rows = materialize(keyed(docs, quality, seed))
    m = plan(rows)
    j = m.join(rows, rows.source)
    return j.select("doc_id", "size", "source_size", "target",
                    (F.col("size") * Mix.copies(F.col("key"))).cast("long").alias("taken"), "source")


def apply(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed table: every row of ``docs`` as often as the mix takes it. Rows without words are left out
    of the fractional pass only when their key is beyond the edge, as any other row."""
    m = plan(materialize(keyed(docs, None, seed)))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    text = F.col("_row.text").cast("string")
    key = -F.log(draw(F.col("_row.doc_id"), seed)) / letter_share(text)
    d = m.join(d, F.col("_row.source").cast("string")).withColumn("_n", Mix.copies(key))
    return d.where("_n > 0").select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int")))).select("_row.*")
