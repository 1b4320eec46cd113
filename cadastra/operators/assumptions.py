"""Planning assumptions blended from the marts.

All blends are single aggregates over the marts (equal-weighted means over
qualifying rows, a lower median of department medians); each has a fallback
constant and a flag or method text saying which one applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.safe import clamp_or_fallback
from cadastra.operators.joins import attach_one_row
from cadastra.operators.materialize import known_rows
from cadastra.operators.median import agg_with_lower_medians
from cadastra.params import DEFAULT, Params

# The method texts of the published assumptions document.
# "{n}" is the number of blended rows.
METHOD_TEXT = {
    "equity": (
        "equal-weighted mean across {n} pea_eligible tickers with enough trading-day history "
        "(see equity_performance_summary.trading_days)",
        "fallback illustrative assumption - no pea_eligible ticker yet has enough trading-day history "
        "(see constants.equities_fallback and equity_performance_summary.trading_days)",
    ),
    "etf": (
        "equal-weighted mean across {n} pea_eligible ETFs with enough trading-day history "
        "(see equity_performance_summary.trading_days)",
        "fallback illustrative assumption - no pea_eligible ETF yet has enough trading-day history "
        "(see constants.equities_fallback and equity_performance_summary.trading_days)",
    ),
    "alternatives": (
        "equal-weighted mean across {n} alternatives tickers with enough trading-day history "
        "(see alternatives_performance_summary.trading_days)",
        "fallback illustrative assumption - no alternatives ticker yet has enough trading-day history "
        "(see constants.alternatives_fallback and alternatives_performance_summary.trading_days)",
    ),
    "liquid": (
        "equal-weighted mean across {n} liquid alternatives tickers with enough trading-day history "
        "(see alternatives_performance_summary.trading_days)",
        "fallback illustrative assumption - no liquid alternatives ticker yet has enough trading-day history "
        "(see constants.alternatives_fallback and alternatives_performance_summary.trading_days)",
    ),
}


def national_median_cagr(dept_score: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Lower median of department CAGR medians, fallback + flag when none."""
    m = agg_with_lower_medians(dept_score.where(F.col("median_price_cagr").isNotNull()), [],
                               {"_m": "median_price_cagr"}, max_exact_group=p.median_max_exact_group,
                               write_sizes=False,  # input: the department mart, one row per department
                               max_rows=known_rows(dept_score))
    # a global aggregate over no rows still yields one row; keep that shape
    m = attach_one_row(dept_score.sparkSession.range(1).select(), m, "left")
    return m.select(
        F.coalesce(F.col("_m"), F.lit(float(p.real_estate_fallback_cagr))).alias("national_median_price_cagr"),
        F.col("_m").isNull().alias("national_median_price_cagr_is_fallback"),
    )


def _blend(prefix: str, cond: Column, fb_ret: float, fb_vol: float) -> list[Column]:
    ok = F.col("annualized_return").isNotNull() & F.col("annualized_volatility").isNotNull() & cond
    n = F.count(F.when(ok, True))
    ret = F.avg(F.when(ok, F.col("annualized_return")))
    vol = F.avg(F.when(ok, F.col("annualized_volatility")))
    used, fallback = METHOD_TEXT[prefix]
    method = F.when(n > 0, F.format_string(used.replace("{n}", "%d"), n)).otherwise(F.lit(fallback))
    return [
        F.coalesce(ret, F.lit(float(fb_ret))).alias(f"{prefix}_annualized_return"),
        F.coalesce(vol, F.lit(float(fb_vol))).alias(f"{prefix}_annualized_volatility"),
        n.alias(f"{prefix}_count"),
        method.alias(f"{prefix}_method"),
    ]


def equity_blends(equity_summary: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A18 (equities): all PEA-eligible tickers, and ETFs only."""
    eligible = equity_summary.where(F.col("pea_eligible") == F.lit(True))
    return eligible.agg(
        *_blend("equity", F.lit(True), p.equities_fallback_return, p.equities_fallback_volatility),
        *_blend("etf", F.col("asset_type") == "etf", p.equities_fallback_return, p.equities_fallback_volatility),
    )


def alternatives_blends(alt_summary: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A18 (alternatives): all tickers, and liquid ones only."""
    return alt_summary.agg(
        *_blend("alternatives", F.lit(True), p.alternatives_fallback_return, p.alternatives_fallback_volatility),
        *_blend("liquid", F.col("liquidity") == "liquid", p.alternatives_fallback_return,
                p.alternatives_fallback_volatility),
    )


def growth_assumptions(equity: DataFrame, alts: DataFrame, national: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The three rates a projection uses, clamped, with fallbacks (X11).

    Inputs are one-row frames; the result is one row.
    """
    j = attach_one_row(attach_one_row(equity, alts, "left"), national, "left")
    return j.select(
        "*",
        clamp_or_fallback(F.col("etf_annualized_return"), p.blended_return_limit, p.equities_fallback_return).alias(
            "pea_growth_rate"
        ),
        clamp_or_fallback(
            F.col("national_median_price_cagr"), p.real_estate_cagr_limit, p.real_estate_fallback_cagr
        ).alias("real_estate_growth_rate"),
        clamp_or_fallback(
            F.col("liquid_annualized_return"), p.blended_return_limit, p.alternatives_fallback_return
        ).alias("alternatives_growth_rate"),
    )


def assumptions_lists(equity_summary: DataFrame, alt_summary: DataFrame, dept_score: DataFrame) -> dict:
    """The per-ticker and per-department lists of the document.

    They grow with the watchlists and the department list, so they stay
    distributed DataFrames (sorted by key, a range-partitioned sort) and are
    written as their own JSON datasets next to the one-row header.
    """
    return {
        "equities_pea_eligible": equity_summary.where(F.col("pea_eligible") == F.lit(True)).select(
            "ticker", "name", "asset_type", "trading_days", "annualized_return", "annualized_volatility"
        ).orderBy("ticker"),
        "alternatives_watchlist": alt_summary.select(
            "ticker", "name", "asset_class", "instrument_type", "liquidity", "trading_days",
            "annualized_return", "annualized_volatility",
        ).orderBy("ticker"),
        "real_estate_by_department": dept_score.where(F.col("median_price_cagr").isNotNull()).select(
            "code_departement", "nom_departement", "median_price_cagr"
        ).orderBy("code_departement"),
    }


def assumptions_document(equity_summary: DataFrame, alt_summary: DataFrame, dept_score: DataFrame,
                         p: Params = DEFAULT) -> DataFrame:
    """The one-row header of the nested document (blends, national CAGR).

    Nested structs rendered with ``to_json``, nulls kept; the lists are in
    :func:`assumptions_lists`.
    """
    g = growth_assumptions(equity_blends(equity_summary, p), alternatives_blends(alt_summary, p),
                           national_median_cagr(dept_score, p), p)

    def blend(prefix: str):
        return F.struct(
            F.col(f"{prefix}_annualized_return").alias("annualized_return"),
            F.col(f"{prefix}_annualized_volatility").alias("annualized_volatility"),
            F.col(f"{prefix}_method").alias("method"),
        )

    doc = F.struct(
        F.struct(blend("equity").alias("blended_default"), blend("etf").alias("etf_blended_default")).alias(
            "equities"),
        F.struct(blend("alternatives").alias("blended_default"),
                 blend("liquid").alias("liquid_blended_default")).alias("alternatives"),
        F.struct("national_median_price_cagr", "national_median_price_cagr_is_fallback").alias("real_estate"),
        F.struct("pea_growth_rate", "real_estate_growth_rate", "alternatives_growth_rate").alias("growth"),
    )
    return g.select(F.to_json(doc, {"ignoreNullFields": "false"}).alias("document"))
