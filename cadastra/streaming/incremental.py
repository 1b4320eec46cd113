"""Incremental latest-wins over a re-delivered landing folder.

New landed files are read as a stream (``trigger(availableNow=True)``) and
appended to a raw table partitioned by load date; nothing is rewritten. The
newest version of every key is picked on read, by ``_ingested_at`` and not by
arrival, so a late re-delivery of an old version loses. A batch that is
replayed, or delivered again after a lost stream checkpoint, only adds copies
that the read drops.

``start_merge`` keeps the newest versions themselves instead: the table is
partitioned by something the key determines (the month of a bar), and a batch
is merged into the partitions it touches: their rows and the batch's, the
newest of each key, overwritten with Spark's dynamic partition overwrite.
Reading is then a scan. The merged partitions are written beside the table
first; if a run is lost while they are put in place, the next one puts them in
place again before anything else, so no partition is lost half-written.
Merging is idempotent, so replays and lost checkpoints change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.operators.dedupe import latest_wins

_PART = "_part"
_DAY = "_load_date"


def start(spark: SparkSession, landing: str, schema: T.StructType, root: str, checkpoint: str,
          max_files_per_trigger: int | None = None):
    """Append whatever has landed to the raw table under ``root``; returns the streaming query."""
    def append(batch: DataFrame, _: int) -> None:
        batch.withColumn(_DAY, F.to_date("_ingested_at")).write.mode("append").partitionBy(_DAY).parquet(root)

    # the table always exists (empty at first), so readers never probe a missing path
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{root}/{_DAY}=1970-01-01")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        reader.parquet(landing)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_current(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str],
                 order: Sequence[Column]) -> DataFrame:
    """The newest version of every key in the raw table."""
    raw = spark.read.schema(schema).parquet(root).select(*schema.fieldNames())
    return latest_wins(raw, keys, order)


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _exists(spark: SparkSession, path: str) -> bool:
    target, fs = _folder(spark, path)
    return fs.exists(target)


def _put_in_place(spark: SparkSession, side: str, schema: T.StructType, root: str) -> None:
    """Overwrite the partitions that the merged rows under ``side`` hold, then drop ``side``."""
    spark.read.schema(schema).parquet(side).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(_PART).parquet(root)
    target, fs = _folder(spark, side)
    fs.delete(target, True)


def start_merge(spark: SparkSession, landing: str, schema: T.StructType, root: str, checkpoint: str,
                keys: Sequence[str], order: Sequence[Column], partition: Column, max_files_per_trigger: int | None = None):
    """Merge whatever has landed into the table under ``root``; returns the streaming query.

    ``partition`` is an expression over the key columns: all versions of a key
    have the same value, so a batch meets them all in the partitions it touches.
    """
    with_part = T.StructType([*schema.fields, T.StructField(_PART, T.StringType())])
    side = f"{root}-merging"

    def merge(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        if _exists(session, f"{side}/_SUCCESS"):  # a run was lost while it put these in place
            _put_in_place(session, side, with_part, root)
        batch = batch.withColumn(_PART, F.coalesce(partition.cast("string"), F.lit("none")))
        touched = [r[0] for r in batch.select(_PART).distinct().collect()]  # the delivered partitions' names
        rows = batch
        if _exists(session, root):
            rows = rows.unionByName(session.read.schema(with_part).parquet(root).where(F.col(_PART).isin(touched)))
        latest_wins(rows, keys, order).write.mode("overwrite").parquet(side)
        _put_in_place(session, side, with_part, root)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        reader.parquet(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_merged(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The table that ``start_merge`` keeps: a scan."""
    if not _exists(spark, root):
        return spark.createDataFrame([], schema)
    with_part = T.StructType([*schema.fields, T.StructField(_PART, T.StringType())])
    return spark.read.schema(with_part).parquet(root).select(*schema.fieldNames())
