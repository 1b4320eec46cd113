"""Connected components of a distributed edge list (alternating stars).

Each round hangs every node's larger neighbours below its smallest one
(large star), then its smaller neighbours (small star). Edges shrink towards
stars whose centre is the smallest node of the component; rounds stop when a
round changes nothing. A node's minimum is aggregated map-side and written
before it is joined back, so the join can split a node of high degree.
Nothing is collected but a row count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.operators.materialize import drop_table, materialize


def _checksum(e: DataFrame):
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first())


def _star(e: DataFrame, sym: DataFrame, keep, rest) -> DataFrame:
    low = materialize(sym.groupBy("u").agg(F.min("v").alias("m")))
    j = sym.join(low, "u")
    out = j.select(F.explode(F.array(*[
        F.struct(a.alias("u"), b.alias("v")) for a, b in keep
    ])).alias("e")) if len(keep) > 1 else j.where(rest).select(keep[0][0].alias("u"), keep[0][1].alias("v"))
    if len(keep) > 1:
        out = out.select("e.u", "e.v")
    out = materialize(out.where("u > v").distinct())
    drop_table(low)
    drop_table(e)
    return out


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge list with long ids; ``root`` is the smallest node.

    Self loops and repeated edges are ignored; nodes that only appear in self
    loops are left out. Null ids are ignored. An empty list gives no rows.
    """
    x, y = F.col(a), F.col(b)
    e = materialize(
        edges.where(x.isNotNull() & y.isNotNull() & (x != y))
        .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    )
    before = _checksum(e)
    while before[0]:
        # large star: larger neighbours of u (u itself counts as a candidate minimum)
        sym = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = _star(e, sym, [(F.col("v"), F.least("m", "u"))], F.col("v") > F.col("u"))
        # small star: u and its smaller neighbours
        e = _star(e, e, [(F.col("u"), F.col("m")), (F.col("v"), F.col("m"))], None)
        after = _checksum(e)
        if after == before:
            break
        before = after
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
