"""Latest-wins dedupe (one row per business key, newest version kept).

``row_number() = 1`` lets Spark plan a partial ``WindowGroupLimit`` before the
shuffle, so re-delivered copies of one key collapse map-side: a key holding a
large share of all copies does not travel whole to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (put the newest first).

    ``order`` must end in a full tiebreak if results have to be repeatable.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def newest_per_key(df: DataFrame, keys: Sequence[str], by: str, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Shorthand: newest by ``by`` descending, then ``tiebreak``."""
    return latest_wins(df, keys, [F.col(by).desc(), *tiebreak])
