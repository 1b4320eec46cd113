"""Running totals over a whole sorted table without a single-task window.

Rows are range-partitioned and sorted, each range sums itself, the ranges'
sums (one row per range) are accumulated in range order, and every row adds
its range's base to its own sum within the range.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@contextmanager
def _at_most(spark: SparkSession, name: str, rows: int):
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, rows: int = 1024):
    """Rows go to Python workers in small batches while this holds: whole texts of many rows are large."""
    return _at_most(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


@contextmanager
def large_rows(spark: SparkSession):
    """While this holds, rows of several MB are read from parquet, and go to Python workers, one by one."""
    with small_batches(spark, 1), _at_most(spark, "spark.sql.parquet.columnarReaderBatchSize", 1):
        yield


def range_bases(sums: DataFrame, part: str, value: str) -> DataFrame:
    """``(part, base)``: the sum of ``value`` over all smaller parts. One input row per part."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(part, F.coalesce(F.sum(value).over(before), F.lit(0)).alias("base"))


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the position (from 0) of every row in the given order.

    ``df`` is written sorted, once. Rows that tie in ``order`` are numbered in
    an arbitrary but gapless way.
    """
    from cadastra.operators.materialize import materialize

    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged.sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sums = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    bases = range_bases(sums, "_part", "_n")
    return ranged.join(bases, "_part").withColumn(name, F.col("base") + F.col("_at")).drop("_part", "_at", "base")
