"""Serving queries over the marts (D01-D13), as DataFrame functions.

Dashboard-side arithmetic re-expressed on Spark: filters, national and
department medians (these interpolate, as the page does), percent
differences, min-max scaling, top-k and headline figures. National figures
are one-row aggregates attached by a broadcast of that one row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions.safe import safe_div
from cadastra.operators.joins import attach_one_row
from cadastra.operators.materialize import known_rows
from cadastra.operators.median import interpolated_medians
from cadastra.operators.ordinal import by_metric, with_ordinal


def filter_communes(score: DataFrame, department: str | None = None, property_type: str | None = None,
                    enabled_types: Iterable[str] | None = None) -> DataFrame:
    """Optional department / type filters and the set of shown types."""
    cond = F.lit(True)
    if department:
        cond = cond & (F.col("code_departement") == department)
    if property_type:
        cond = cond & (F.col("type_local") == property_type)
    if enabled_types is not None:
        cond = cond & F.col("type_local").isin(*list(enabled_types))
    return score.where(cond)


def ranked_communes(score: DataFrame, **filters) -> DataFrame:
    """D01 as shown: the filtered communes with their place by descending score, missing scores last."""
    return with_ordinal(filter_communes(score, **filters), by_metric("opportunity_score", "code_commune", "type_local"))


def national_medians(score: DataFrame) -> DataFrame:
    """Interpolated medians of income and population, one row per commune."""
    per_commune = score.groupBy("code_commune").agg(
        F.min_by("median_disposable_income", "type_local").alias("median_disposable_income"),
        F.min_by("population", "type_local").alias("population"),
    )
    return interpolated_medians(per_commune, [], {
        "national_median_income": "median_disposable_income",
        "national_median_population": "population",
    }, write_sizes=False, max_rows=known_rows(score))  # one row per commune: at most the mart's rows


def vs_national_median(score: DataFrame) -> DataFrame:
    """Percent difference from the national medians (null-safe)."""
    nat = national_medians(score)
    j = attach_one_row(score, nat, "left")
    return j.select(
        "code_commune",
        "type_local",
        "national_median_income",
        "national_median_population",
        (F.col("price_vs_national_median_ratio") - F.lit(1.0)).alias("price_vs_national_median_pct"),
        F.when(F.col("national_median_income") != 0,
               safe_div(F.col("median_disposable_income"), F.col("national_median_income")) - F.lit(1.0)
               ).alias("income_vs_national_median_pct"),
        F.when(F.col("national_median_population") != 0,
               safe_div(F.col("population"), F.col("national_median_population")) - F.lit(1.0)
               ).alias("population_vs_national_median_pct"),
    )


def department_medians(filtered: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Department median score (interpolated) and distinct communes.

    ``max_rows``: an upper bound on the filtered rows (e.g. the mart's count).
    """
    return interpolated_medians(
        filtered, ["code_departement"], {"median_score": "opportunity_score"},
        extra_aggs=[F.min("nom_departement").alias("nom_departement"),
                    F.countDistinct("code_commune").alias("commune_count")],
        write_sizes=False,  # serving reads the written mart
        max_rows=max_rows,
    )


def min_max_scale(df: DataFrame, col: str, out: str = "scaled") -> DataFrame:
    """(v - min) / (max - min) in 0..1, 0.5 when flat or missing span.

    min/max come from a one-row aggregate (partial on every partition),
    attached by broadcast: no single-task window over the whole table.
    """
    mm = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    j = attach_one_row(df, mm, "left")
    span = F.col("_hi") - F.col("_lo")
    scaled = F.when(F.col(col).isNull(), F.lit(None)).when(span > 0, (F.col(col) - F.col("_lo")) / span).otherwise(
        F.lit(0.5)
    )
    return j.withColumn(out, scaled.cast("double")).drop("_lo", "_hi")


def top_n(df: DataFrame, metric: str, n: int, *tiebreak: str) -> DataFrame:
    """The n best rows by ``metric`` (missing last), key tiebreak.

    Planned as TakeOrderedAndProject: each partition keeps its own top n.
    """
    return df.orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc() for c in tiebreak]).limit(n)


def rank_by_metric(df: DataFrame, metric: str, asset_type: str | None = None, key: str = "ticker") -> DataFrame:
    """Optional asset-type filter, ordered by metric desc, missing last."""
    if asset_type:
        df = df.where(F.col("asset_type") == asset_type)
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(key).asc())


def risk_return_pairs(df: DataFrame) -> DataFrame:
    """Rows with both volatility and return present."""
    return df.where(F.col("annualized_volatility").isNotNull() & F.col("annualized_return").isNotNull())


def price_score_pairs(score: DataFrame) -> DataFrame:
    """Rows with a price present."""
    return score.where(F.col("median_price_per_sqm").isNotNull())


def best(metric: str, key: str = "ticker"):
    """The key with the highest non-null metric; ties go to the smallest key."""
    m = F.col(metric)
    return F.min_by(F.col(key), F.when(m.isNotNull(), F.struct(-m, F.col(key))))


def equity_kpis(summary: DataFrame) -> DataFrame:
    """Counts by type, null-ignoring averages, best return and Sharpe."""
    is_stock = F.col("asset_type") == "stock"
    is_etf = F.col("asset_type") == "etf"
    return summary.agg(
        F.count(F.lit(1)).alias("ticker_count"),
        F.count(F.when(is_stock, True)).alias("stock_count"),
        F.count(F.when(is_etf, True)).alias("etf_count"),
        F.avg("annualized_return").alias("avg_return"),
        F.avg(F.when(is_stock, F.col("annualized_return"))).alias("avg_return_stock"),
        F.avg(F.when(is_etf, F.col("annualized_return"))).alias("avg_return_etf"),
        F.avg("annualized_volatility").alias("avg_volatility"),
        best("annualized_return").alias("best_return_ticker"),
        best("sharpe_ratio").alias("best_sharpe_ticker"),
    )


def alternatives_kpis(summary: DataFrame, instrument: str | None = None) -> DataFrame:
    """Optional instrument filter, liquid count, averages, best return."""
    if instrument:
        summary = summary.where(F.col("instrument_type") == instrument)
    return summary.agg(
        F.count(F.lit(1)).alias("ticker_count"),
        F.count(F.when(F.col("liquidity") == "liquid", True)).alias("liquid_count"),
        F.avg("annualized_return").alias("avg_return"),
        F.avg("annualized_volatility").alias("avg_volatility"),
        F.avg("period_return_pct").alias("avg_period_return"),
        best("annualized_return").alias("best_return_ticker"),
        # a summary may come without the ratio
        *([best("sharpe_ratio").alias("best_sharpe_ticker")] if "sharpe_ratio" in summary.columns else []),
    )


def commune_kpis(score: DataFrame, mart: DataFrame | None = None) -> DataFrame:
    """Distinct communes, top commune by score, the three national medians.

    ``score`` may be filtered; the medians of income and population are those of
    the whole ``mart`` (``score`` itself if none is given).
    """
    kpis = score.agg(
        F.countDistinct("code_commune").alias("commune_count"),
        F.min_by(F.col("nom_commune"), F.when(F.col("opportunity_score").isNotNull(), F.struct(
            -F.col("opportunity_score"), F.col("code_commune"), F.col("type_local")))).alias("top_commune"),
        F.max("opportunity_score").alias("top_score"),
        F.max("national_median_price_per_sqm").alias("national_median_price_per_sqm"),
    )
    return attach_one_row(kpis, national_medians(score if mart is None else mart), "left")


def distinct_options(df: DataFrame, col: str) -> DataFrame:
    """The sorted distinct values of a column (filter option lists)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
