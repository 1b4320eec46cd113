"""Positions in a distributed order.

A mart's published order, and the place of each row in a list, without a
window over the whole table: rows are range-partitioned and sorted, every
range numbers its own rows, and a row per range carries the rows before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.materialize import materialize

_IN_RANGE = (1 << 33) - 1  # monotonically_increasing_id: the row within its partition


def by_metric(metric: str, *tiebreak: str) -> list[Column]:
    """Descending metric, missing last, then the keys."""
    return [F.col(metric).desc_nulls_last(), *[F.col(c).asc() for c in tiebreak]]


def with_ordinal(df: DataFrame, order: Sequence[Column], name: str = "ordinal") -> DataFrame:
    """Add the position (from 1) of every row in ``order``; gapless.

    The sorted rows are written once, so that ranges and positions stay as they
    are. Rows that tie in ``order`` get successive positions in any order.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = materialize(ranges.withColumn("_range", F.spark_partition_id()).withColumn(
        "_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_RANGE))))
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranges.join(starts, "_range").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_range", "_at", "_before")
