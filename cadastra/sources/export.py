"""Exports (S18, S19): marts to JSON and the manifest of row counts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines, dates as ISO strings, nulls kept as explicit fields."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def manifest(marts: Mapping[str, DataFrame], exported_at: datetime | None = None) -> DataFrame:
    """One row per mart with its row count (one aggregate each)."""
    out = None
    for name, df in marts.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("mart"), "row_count")
        out = row if out is None else out.unionByName(row)
    if exported_at is not None:
        out = out.withColumn("exported_at", F.lit(exported_at).cast("timestamp"))
    return out
