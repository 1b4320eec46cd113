"""Cutting lineage on reused intermediates.

``materialize`` writes a DataFrame as parquet under the shared folder the
cluster names in ``spark.checkpoint.dir`` and reads it back: later stages
re-read compact columnar files instead of recomputing shuffles, and a lost
executor does not force the upstream stages to rerun. A scratch folder is
used only when that setting is absent (local tests).

The row count is observed during the write (no extra job) and remembered
for the returned scan: ``known_rows(df)`` lets a consumer skip a size check.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from cadastra.session import ensure_checkpoint_dir

_ROWS_ATTR = "_cadastra_known_rows"
_PATH_ATTR = "_cadastra_path"


def table_dir(df: DataFrame, name: str | None = None) -> str:
    root = ensure_checkpoint_dir(df.sparkSession)
    return os.path.join(root, "cadastra-tables", name or uuid.uuid4().hex)


def materialize(df: DataFrame, name: str | None = None, **options) -> DataFrame:
    """Write ``df`` to a fresh parquet table in the shared folder; return a scan of it. ``options`` are the writer's."""
    path = table_dir(df, name)
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").options(**options).parquet(path)
    out = df.sparkSession.read.parquet(path)
    setattr(out, _ROWS_ATTR, int(obs.get["n"]))  # derived frames do not inherit it
    setattr(out, _PATH_ATTR, path)
    return out


def known_rows(df: DataFrame) -> int | None:
    """Row count of a scan returned by :func:`materialize` (None for anything else)."""
    return getattr(df, _ROWS_ATTR, None)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table returned by :func:`materialize`, once nothing reads it any more."""
    path = getattr(df, _PATH_ATTR, None)
    if path is None:
        return
    jvm = df.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
