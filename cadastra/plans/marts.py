"""Building the published marts as tables, then exporting them.

Views stay lazy DataFrames; the four marts are written as parquet tables
(``mode("overwrite")``), and every export reads the written tables back, so
no mart is computed twice and a lost executor only reruns the current step.
"""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from cadastra.operators import assumptions, places
from cadastra.plans.inputs import Inputs
from cadastra.sources import document
from cadastra.sources.export import export_json, manifest

MARTS = ("commune_opportunity_score", "department_opportunity_score",
         "equity_performance_summary", "alternatives_performance_summary")


def build(inputs: Inputs, out_root: str) -> dict[str, DataFrame]:
    """Write the four marts under ``out_root/marts`` and return scans of them."""
    spark = inputs.spark
    paths = {m: os.path.join(out_root, "marts", m) for m in MARTS}
    # each mart is written in its published order: descending, missing last, then by key
    places.order_by_score(inputs.score, "opportunity_score", "code_commune", "type_local").write.mode("overwrite").parquet(paths["commune_opportunity_score"])
    score = spark.read.parquet(paths["commune_opportunity_score"])
    rollup = places.department_opportunity_score(score, inputs.p, score_is_table=True)
    places.order_by_score(rollup, "median_opportunity_score", "code_departement").write.mode("overwrite").parquet(
        paths["department_opportunity_score"])
    places.order_by_score(inputs.equity_summary, "annualized_return", "ticker").write.mode("overwrite").parquet(
        paths["equity_performance_summary"])
    places.order_by_score(inputs.alt_summary, "annualized_return", "ticker").write.mode("overwrite").parquet(
        paths["alternatives_performance_summary"])
    return {m: spark.read.parquet(p) for m, p in paths.items()}


def export(marts: dict[str, DataFrame], out_root: str, params, exported_at: datetime | None = None) -> DataFrame:
    """JSON per mart, the manifest of row counts, and the assumptions document."""
    ts = exported_at or datetime.now(timezone.utc)
    for name, df in marts.items():
        export_json(df, os.path.join(out_root, "json", name))
    meta = manifest(marts, ts)
    meta.write.mode("overwrite").json(os.path.join(out_root, "json", "meta"))
    doc = assumptions.assumptions_document(
        marts["equity_performance_summary"], marts["alternatives_performance_summary"],
        marts["department_opportunity_score"], params,
    )
    doc.write.mode("overwrite").text(os.path.join(out_root, "json", "wealth_assumptions", "header"))
    lists = assumptions.assumptions_lists(
        marts["equity_performance_summary"], marts["alternatives_performance_summary"],
        marts["department_opportunity_score"],
    )
    for name, df in lists.items():
        export_json(df, os.path.join(out_root, "json", "wealth_assumptions", name))
    document.write(document.lines(
        marts["equity_performance_summary"], marts["alternatives_performance_summary"],
        marts["department_opportunity_score"], ts, params), os.path.join(out_root, "json", "wealth_assumptions", "document"))
    return meta
