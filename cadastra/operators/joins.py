"""Attaching one-row relations (scalars) to every row of a table.

A one-row aggregate (a global max, a benchmark's window) is joined on a
constant key, broadcast: the build side is one row by construction, so the
broadcast is bounded whatever the data size. ``how="left"`` keeps every row
when the relation is empty (the ``left join ... on true`` of the reference).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_KEY = "_scalar_key"


def attach_one_row(df: DataFrame, one_row: DataFrame, how: str = "inner") -> DataFrame:
    """Add the columns of a 0-or-1-row DataFrame to every row of ``df``; more rows are an error."""
    rows = F.count(F.lit(1)).over(Window.partitionBy())
    checked = one_row.withColumn(_KEY, F.when(rows > 1, F.raise_error(F.lit("expected at most one row"))
                                             .cast("int")).otherwise(F.lit(1)))
    right = F.broadcast(checked.where(F.col(_KEY) == 1))
    return df.withColumn(_KEY, F.lit(1)).join(right, _KEY, how).drop(_KEY)
