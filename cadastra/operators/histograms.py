"""Mergeable exact histograms of the commune mart.

One pass over the mart counts its scores per department and type. A score has
one decimal, so a histogram has at most a thousand bins, and the histogram of
any filter (a department, a set of shown types) is the sum of the histograms
it admits: its exact median needs no row of the mart. Communes are counted by
the set of types they appear with, so that a filter counts each of them once;
incomes and populations are counted once per commune.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.materialize import materialize


@dataclass(frozen=True)
class CommuneHistograms:
    scores: DataFrame  # code_departement, nom_departement, type_local, value, n
    communes: DataFrame  # code_departement, types, n
    nationwide: DataFrame  # metric, value, n


def build(score: DataFrame) -> CommuneHistograms:
    """The mart's histograms, written once."""
    scores = score.groupBy("code_departement", "type_local", F.col("opportunity_score").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.min("nom_departement").alias("nom_departement"))
    once = materialize(score.groupBy("code_departement", "code_commune").agg(
        F.array_sort(F.collect_set("type_local")).alias("types"),
        F.min_by("median_disposable_income", "type_local").alias("income"),
        F.min_by("population", "type_local").cast("double").alias("population")))
    communes = once.groupBy("code_departement", "types").agg(F.count(F.lit(1)).alias("n"))
    metrics = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("income", "population")]))
    nationwide = once.select(metrics.alias("m")).select("m.*").groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"))
    return CommuneHistograms(materialize(scores), materialize(communes), materialize(nationwide))


def medians(histogram: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by``, median: interpolated median of the summed bins of each group; null values count in none."""
    bins = histogram.where(F.col("value").isNotNull()).groupBy(*by, "value").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by)
    upto = group.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = bins.select(*by, "value", F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("total"))
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col("value")))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    return ranked.groupBy(*by).agg(((at(low) + at(high)) / 2).alias("median"))


def department_medians(h: CommuneHistograms, department: str | None = None, types: Sequence[str] | None = None) -> DataFrame:
    """D05 for one filter: code_departement, nom_departement, median_score, commune_count."""
    scores, communes = h.scores, h.communes
    if department is not None:
        scores, communes = (d.where(F.col("code_departement") == department) for d in (scores, communes))
    if types is not None:
        shown = F.array(*[F.lit(t) for t in types]).cast("array<string>")
        scores = scores.where(F.col("type_local").isin(list(types)))
        communes = communes.where(F.arrays_overlap("types", shown))
    key = ["code_departement"]
    named = scores.groupBy(*key).agg(F.min("nom_departement").alias("nom_departement"))
    counted = communes.groupBy(*key).agg(F.sum("n").alias("commune_count"))
    same = lambda a, b: a["code_departement"].eqNullSafe(b["code_departement"])
    m = medians(scores, key)
    out = named.join(m, same(named, m), "left").join(counted, same(named, counted), "left")
    return out.select(named["code_departement"], "nom_departement", F.col("median").alias("median_score"), "commune_count")


def national_medians(h: CommuneHistograms) -> DataFrame:
    """One row, the national medians of income and population."""
    m = medians(h.nationwide, ["metric"])
    return m.agg(*[F.max(F.when(F.col("metric") == c, F.col("median"))).alias(f"national_median_{c}") for c in ("income", "population")])
