"""Registered queries: key -> (DataFrame function, oracle SQL).

Every function takes (spark, sf_dir) and returns a lazy DataFrame over the
whole test tables. Doubles that come from order-dependent aggregates or
``pow`` are rounded to 6 digits here and in the SQL (engines differ in the
last bits there); exact values (medians, ratios, counts) are left as is.
"""

from __future__ import annotations

import dataclasses
import os
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.operators import assumptions, histograms, places, quality, serving, series
from cadastra.operators.joins import attach_one_row
from cadastra.operators.materialize import known_rows, materialize
from cadastra.plans.inputs import Inputs
from cadastra.plans.oracle import r6, with_ctes
from cadastra.sources import landing
from cadastra.sources import testdata as td
from cadastra.session import ensure_checkpoint_dir, parallelism

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def R(c: str, alias: str | None = None):
    return F.round(F.col(c), 6).alias(alias or c)


BAR_COLS = ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume", "dividends", "stock_splits"]


# --- staging -------------------------------------------------------------------------------------
@query("latest_wins_bars", with_ctes(
    "SELECT ticker, date, close AS open, close AS high, close AS low, close, adj_close,"
    " CAST(NULL AS BIGINT) AS volume, CAST(NULL AS DOUBLE) AS dividends, CAST(NULL AS DOUBLE) AS stock_splits"
    " FROM alt_prices"))
def latest_wins_bars(spark, sf):
    return Inputs(spark, sf).alt_prices.select(*BAR_COLS)


@query("latest_wins_sales", with_ctes("""
SELECT CAST(l_orderkey AS VARCHAR) AS id_mutation, CAST(l_shipdate AS DATE) AS date_mutation,
       CASE WHEN l_linenumber = 7 THEN 'Adjudication' ELSE 'Vente' END AS nature_mutation,
       l_extendedprice AS valeur_fonciere, CAST(l_suppkey AS VARCHAR) AS code_commune, s_name AS nom_commune,
       CAST(s_nationkey AS VARCHAR) AS code_departement, 'P' || CAST(l_orderkey AS VARCHAR) AS id_parcelle,
       l_returnflag AS type_local, l_quantity AS surface_reelle_bati,
       CAST(l_linenumber AS BIGINT) AS nombre_pieces_principales, l_discount * 100 AS surface_terrain,
       CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS DOUBLE) AS latitude,
       CAST(year(l_shipdate) AS INTEGER) AS source_year, CAST(s_nationkey AS VARCHAR) AS source_departement
FROM stg_tx"""))
def latest_wins_sales(spark, sf):
    return Inputs(spark, sf).sales


# --- property branch -------------------------------------------------------------------------------
@query("period_stats", with_ctes("SELECT * FROM period_stats"))
def period_stats(spark, sf):
    return Inputs(spark, sf).period_stats


@query("period_stats_thin_years", with_ctes("SELECT * FROM period_stats", min_reliable=20))
def period_stats_thin_years(spark, sf):
    return Inputs(spark, sf, td.TEST_PARAMS.with_(min_reliable_transaction_count=20)).period_stats


@query("price_cagr", with_ctes(
    "SELECT code_commune, type_local, first_year, last_year, year_span, first_year_price, last_year_price, "
    f"{r6('price_cagr')} AS price_cagr FROM price_cagr"))
def price_cagr(spark, sf):
    return Inputs(spark, sf).price_cagr.withColumn("price_cagr", F.round("price_cagr", 6))


@query("commune_indicators", with_ctes("SELECT * FROM indicators"))
def commune_indicators(spark, sf):
    return Inputs(spark, sf).indicators


@query("population_cagr", with_ctes(
    "SELECT code_insee, nom_commune, code_departement, first_year, last_year, year_span, first_year_population,"
    f" last_year_population, {r6('population_cagr')} AS population_cagr FROM population_cagr"))
def population_cagr(spark, sf):
    return Inputs(spark, sf).population_cagr.withColumn("population_cagr", F.round("population_cagr", 6))


@query("latest_rate", with_ctes("SELECT * FROM latest_tax"))
def latest_rate(spark, sf):
    return Inputs(spark, sf).latest_tax


@query("tax_penalty", with_ctes(
    "SELECT code_commune, taux_foncier_bati,"
    " round(least(1.0, greatest(0.0, coalesce(taux_foncier_bati, 0) - 35.0) / 35.0) * 15.0, 1)"
    " AS property_tax_penalty_pts,"
    f" {r6('least(1.0, greatest(0.0, coalesce(taux_foncier_bati, 0) - 35.0) / 35.0) * 15.0')}"
    " AS property_tax_penalty_raw FROM latest_tax"))
def tax_penalty(spark, sf):
    i = Inputs(spark, sf)
    pen = places.tax_penalty(F.col("taux_foncier_bati"), i.p)
    return i.latest_tax.select(
        "code_commune", "taux_foncier_bati",
        F.round(pen, 1).alias("property_tax_penalty_pts"), F.round(pen, 6).alias("property_tax_penalty_raw"),
    )


SCORE_ROUNDED = ["price_cagr", "population_cagr"]


def _score_cols(df: DataFrame) -> DataFrame:
    return df.select(*[R(c) if c in SCORE_ROUNDED else c for c in df.columns])


_SCORE_SQL_COLS = """code_commune, nom_commune, code_departement, nom_departement, type_local, year,
  transaction_count, median_price_per_sqm, yoy_price_change_pct, {pc} AS price_cagr, cagr_first_year,
  cagr_last_year, population, densite, median_disposable_income, {popc} AS population_cagr,
  population_cagr_first_year, population_cagr_last_year, taux_foncier_bati, tax_year,
  national_median_price_per_sqm, price_vs_national_median_ratio, transactions_per_capita,
  population_share_of_department, property_tax_penalty_pts, opportunity_score""".format(
    pc=r6("price_cagr"), popc=r6("population_cagr"))


@query("opportunity_score", with_ctes(f"SELECT {_SCORE_SQL_COLS} FROM commune_score"))
def opportunity_score(spark, sf):
    return _score_cols(places.order_by_score(Inputs(spark, sf).score, "opportunity_score",
                                             "code_commune", "type_local"))


@query("department_rollup", with_ctes(
    "SELECT code_departement, nom_departement, commune_count, median_opportunity_score, median_price_per_sqm,"
    f" {r6('median_price_cagr')} AS median_price_cagr, total_transactions FROM dept_score"))
def department_rollup(spark, sf):
    d = Inputs(spark, sf).dept_score
    return places.order_by_score(d, "median_opportunity_score", "code_departement").withColumn(
        "median_price_cagr", F.round("median_price_cagr", 6))


@query("national_median_cagr", with_ctes(
    f"SELECT {r6('coalesce(m, 0.03)')} AS national_median_price_cagr,"
    " m IS NULL AS national_median_price_cagr_is_fallback FROM"
    " (SELECT CAST(quantile_disc(median_price_cagr, 0.5) AS DOUBLE) AS m FROM dept_score"
    "  WHERE median_price_cagr IS NOT NULL)"))
def national_median_cagr(spark, sf):
    i = Inputs(spark, sf)
    return assumptions.national_median_cagr(i.dept_score, i.p).withColumn(
        "national_median_price_cagr", F.round("national_median_price_cagr", 6))


# --- price-series branch ---------------------------------------------------------------------------------
@query("daily_returns", with_ctes(
    "SELECT ticker, date, adj_close, daily_return,"
    f" {r6('rolling_30d_volatility')} AS rolling_30d_volatility, drawdown_pct FROM eq_returns"))
def daily_returns(spark, sf):
    i = Inputs(spark, sf)
    return series.daily_returns(i.equity_prices, i.p).withColumn(
        "rolling_30d_volatility", F.round("rolling_30d_volatility", 6))


@query("rolling_volatility", with_ctes(
    f"SELECT ticker, date, {r6('rolling_30d_volatility')} AS rolling_30d_volatility FROM eq_returns"))
def rolling_volatility(spark, sf):
    return daily_returns(spark, sf).select("ticker", "date", "rolling_30d_volatility")


@query("running_drawdown", with_ctes("SELECT ticker, date, adj_close, drawdown_pct FROM eq_returns"))
def running_drawdown(spark, sf):
    i = Inputs(spark, sf)
    return series.daily_returns(i.equity_prices, i.p).select("ticker", "date", "adj_close", "drawdown_pct")


@query("end_prices", with_ctes("SELECT ticker, first_price, last_price FROM eq_per_ticker"))
def end_prices(spark, sf):
    i = Inputs(spark, sf)
    return series.end_prices(series.daily_returns(i.equity_prices, i.p), i.p)


ALT_ROUNDED = ["avg_daily_return", "annualized_volatility", "annualized_return", "sharpe_ratio"]
EQ_ROUNDED = ALT_ROUNDED + ["relative_performance_vs_benchmark", "total_dividends", "dividend_yield_pct"]


def _rounded(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[R(c) if c in cols else c for c in df.columns])


def _sql_cols(cols: list[str], rounded: list[str]) -> str:
    return ", ".join(f"{r6(c)} AS {c}" if c in rounded else c for c in cols)


ALT_COLS = ["ticker", "name", "asset_class", "instrument_type", "liquidity", "first_date", "last_date",
            "first_price", "last_price", "period_return_pct", "trading_days", "avg_daily_return",
            "annualized_volatility", "annualized_return", "max_drawdown_pct", "sharpe_ratio"]
EQ_COLS = ["ticker", "name", "asset_type", "sector", "isin", "country", "pea_eligible", "first_date", "last_date",
           "first_price", "last_price", "period_return_pct", "trading_days", "avg_daily_return",
           "annualized_volatility", "annualized_return", "max_drawdown_pct", "sharpe_ratio",
           "relative_performance_vs_benchmark", "total_dividends", "dividend_yield_pct"]


@query("performance_gated_out", with_ctes(f"SELECT {_sql_cols(ALT_COLS, ALT_ROUNDED)} FROM alt_summary"))
def performance_gated_out(spark, sf):
    return _rounded(Inputs(spark, sf).alt_summary, ALT_ROUNDED)


@query("performance_summary", with_ctes(f"SELECT {_sql_cols(EQ_COLS, EQ_ROUNDED)} FROM equity_summary"))
def performance_summary(spark, sf):
    s = Inputs(spark, sf).equity_summary
    return _rounded(serving.rank_by_metric(s, "annualized_return"), EQ_ROUNDED)


@query("relative_performance", with_ctes(
    "SELECT e.ticker, e.trading_days, "
    f"{r6('vb.aligned_annualized_return')} AS aligned_annualized_return, "
    f"{r6('e.relative_performance_vs_benchmark')} AS relative_performance_vs_benchmark "
    "FROM equity_summary e LEFT JOIN vs_benchmark vb ON e.ticker = vb.ticker"))
def relative_performance(spark, sf):
    i = Inputs(spark, sf)
    vb = series.aligned_returns(series.daily_returns(i.equity_prices, i.p), i.p)
    s = i.equity_summary.select("ticker", "trading_days", "relative_performance_vs_benchmark")
    return s.join(vb, "ticker", "left").select(
        "ticker", "trading_days", R("aligned_annualized_return"), R("relative_performance_vs_benchmark"))


@query("relative_performance_no_benchmark", with_ctes(
    f"SELECT ticker, {r6('annualized_return')} AS annualized_return, relative_performance_vs_benchmark"
    " FROM equity_summary", bench=f"'{td.MISSING_BENCHMARK_TICKER}'"))
def relative_performance_no_benchmark(spark, sf):
    i = Inputs(spark, sf, td.TEST_PARAMS.with_(benchmark_ticker=td.MISSING_BENCHMARK_TICKER))
    return i.equity_summary.select("ticker", R("annualized_return"), "relative_performance_vs_benchmark")


# --- assumptions -----------------------------------------------------------------------------------------
def _blend_sql(prefix: str, cond: str, fb_ret: float, fb_vol: float) -> str:
    used, fallback = assumptions.METHOD_TEXT[prefix]
    head, tail = used.split("{n}")
    ok = f"annualized_return IS NOT NULL AND annualized_volatility IS NOT NULL AND {cond}"
    n = f"count(CASE WHEN {ok} THEN 1 END)"
    return (
        f"{r6(f'coalesce(avg(CASE WHEN {ok} THEN annualized_return END), {fb_ret})')} AS {prefix}_annualized_return, "
        f"{r6(f'coalesce(avg(CASE WHEN {ok} THEN annualized_volatility END), {fb_vol})')} "
        f"AS {prefix}_annualized_volatility, "
        f"{n} AS {prefix}_count, "
        f"CASE WHEN {n} > 0 THEN '{head}' || CAST({n} AS VARCHAR) || '{tail}' ELSE '{fallback}' END "
        f"AS {prefix}_method"
    )


def _clamp_sql(x: str, lim: float, fb: float) -> str:
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) THEN {fb} ELSE greatest(-{lim}, least({lim}, {x})) END"


_BLEND_SELECT = f"""
SELECT e.*, a.*, n.*,
  {r6(_clamp_sql('e.etf_annualized_return', 0.2, 0.07))} AS pea_growth_rate,
  {r6(_clamp_sql('n.national_median_price_cagr', 0.15, 0.03))} AS real_estate_growth_rate,
  {r6(_clamp_sql('a.liquid_annualized_return', 0.2, 0.06))} AS alternatives_growth_rate
FROM (SELECT {_blend_sql('equity', 'true', 0.07, 0.15)},
             {_blend_sql('etf', "asset_type = 'etf'", 0.07, 0.15)}
      FROM equity_summary WHERE pea_eligible = true) e
CROSS JOIN (SELECT {_blend_sql('alternatives', 'true', 0.06, 0.35)},
                   {_blend_sql('liquid', "liquidity = 'liquid'", 0.06, 0.35)}
            FROM alt_summary) a
CROSS JOIN (SELECT {r6('coalesce(m, 0.03)')} AS national_median_price_cagr,
                   m IS NULL AS national_median_price_cagr_is_fallback
            FROM (SELECT CAST(quantile_disc(median_price_cagr, 0.5) AS DOUBLE) AS m FROM dept_score
                  WHERE median_price_cagr IS NOT NULL)) n
"""
_BLEND_SQL = with_ctes(_BLEND_SELECT)


@query("blended_assumptions", _BLEND_SQL)
def blended_assumptions(spark, sf):
    i = Inputs(spark, sf)
    g = assumptions.growth_assumptions(
        assumptions.equity_blends(i.equity_summary, i.p),
        assumptions.alternatives_blends(i.alt_summary, i.p),
        assumptions.national_median_cagr(i.dept_score, i.p),
        i.p,
    )
    rounded = [c for c in g.columns if c.endswith(("_return", "_volatility", "_rate")) or c == "national_median_price_cagr"]
    return g.select(*[R(c) if c in rounded else c for c in g.columns])


# --- serving ---------------------------------------------------------------------------------------------
_NAT_SQL = """(SELECT median(CAST(median_disposable_income AS DOUBLE)) AS national_median_income,
                      median(CAST(population AS DOUBLE)) AS national_median_population
               FROM (SELECT code_commune, arg_min(median_disposable_income, type_local) AS median_disposable_income,
                            arg_min(population, type_local) AS population
                     FROM commune_score GROUP BY code_commune))"""


@query("vs_national_median", with_ctes(f"""
SELECT s.code_commune, s.type_local, {r6('n.national_median_income')} AS national_median_income,
       {r6('n.national_median_population')} AS national_median_population,
       {r6('s.price_vs_national_median_ratio - 1')} AS price_vs_national_median_pct,
       {r6('CASE WHEN n.national_median_income <> 0 THEN s.median_disposable_income / n.national_median_income - 1 END')}
         AS income_vs_national_median_pct,
       {r6('CASE WHEN n.national_median_population <> 0 THEN s.population / n.national_median_population - 1 END')}
         AS population_vs_national_median_pct
FROM commune_score s CROSS JOIN {_NAT_SQL} n"""))
def vs_national_median(spark, sf):
    v = serving.vs_national_median(Inputs(spark, sf).score_table)
    return v.select("code_commune", "type_local", *[R(c) for c in v.columns[2:]])


@query("filtered_department_medians", with_ctes(f"""
SELECT code_departement, min(nom_departement) AS nom_departement,
       {r6('median(opportunity_score)')} AS median_score, count(DISTINCT code_commune) AS commune_count
FROM commune_score WHERE type_local = 'A' AND type_local IN ('A', 'R') GROUP BY code_departement"""))
def filtered_department_medians(spark, sf):
    score = Inputs(spark, sf).score_table
    f = serving.filter_communes(score, property_type="A", enabled_types=["A", "R"])
    return serving.department_medians(f, max_rows=known_rows(score)).withColumn(
        "median_score", F.round("median_score", 6))


_HISTOGRAM_FILTERS = {"A": ("A",), "both": ("A", "R")}


@query("histogram_department_medians", with_ctes(" UNION ALL ".join(f"""
SELECT '{name}' AS filter, code_departement, min(nom_departement) AS nom_departement,
       {r6('median(opportunity_score)')} AS median_score, count(DISTINCT code_commune) AS commune_count
FROM commune_score WHERE type_local IN ({', '.join(repr(t) for t in types)}) GROUP BY code_departement"""
                                                                    for name, types in _HISTOGRAM_FILTERS.items())))
def histogram_department_medians(spark, sf):
    """D05 for two filters, merged from histograms; the mart is read once to build them."""
    h = histograms.build(Inputs(spark, sf).score_table)
    return landing.union_frames([
        histograms.department_medians(h, types=types).select(
            F.lit(name).alias("filter"), "code_departement", "nom_departement", R("median_score"), "commune_count")
        for name, types in _HISTOGRAM_FILTERS.items()])


@query("histogram_national_medians", with_ctes(
    f"SELECT {r6('national_median_income')} AS national_median_income,"
    f" {r6('national_median_population')} AS national_median_population FROM {_NAT_SQL}"))
def histogram_national_medians(spark, sf):
    """D02 from the same histograms."""
    m = histograms.national_medians(histograms.build(Inputs(spark, sf).score_table))
    return m.select(R("national_median_income"), R("national_median_population"))


@query("map_scale", with_ctes(f"""
SELECT code_departement, median_opportunity_score,
  {r6('CASE WHEN median_opportunity_score IS NULL THEN NULL WHEN hi - lo > 0 THEN (median_opportunity_score - lo) / (hi - lo) ELSE 0.5 END')} AS scaled
FROM dept_score CROSS JOIN (SELECT min(median_opportunity_score) AS lo, max(median_opportunity_score) AS hi FROM dept_score)"""))
def map_scale(spark, sf):
    d = Inputs(spark, sf).dept_score.select("code_departement", "median_opportunity_score")
    return serving.min_max_scale(d, "median_opportunity_score").withColumn("scaled", F.round("scaled", 6))


@query("top_communes", with_ctes(
    "SELECT code_commune, nom_commune, type_local, opportunity_score FROM commune_score"
    " ORDER BY opportunity_score DESC NULLS LAST, code_commune, type_local LIMIT 15"))
def top_communes(spark, sf):
    s = Inputs(spark, sf).score.select("code_commune", "nom_commune", "type_local", "opportunity_score")
    return serving.top_n(s, "opportunity_score", 15, "code_commune", "type_local")


@query("top_departments", with_ctes(
    "SELECT code_departement, nom_departement, median_opportunity_score FROM dept_score"
    " ORDER BY median_opportunity_score DESC NULLS LAST, code_departement LIMIT 5"))
def top_departments(spark, sf):
    d = Inputs(spark, sf).dept_score.select("code_departement", "nom_departement", "median_opportunity_score")
    return serving.top_n(d, "median_opportunity_score", 5, "code_departement")


@query("rank_by_metric", with_ctes(
    f"SELECT ticker, {r6('annualized_return')} AS annualized_return,"
    f" {r6('annualized_volatility')} AS annualized_volatility, {r6('sharpe_ratio')} AS sharpe_ratio"
    " FROM equity_summary WHERE asset_type = 'stock'"
    " AND annualized_volatility IS NOT NULL AND annualized_return IS NOT NULL"))
def rank_by_metric(spark, sf):
    s = serving.risk_return_pairs(Inputs(spark, sf).equity_summary)
    r = serving.rank_by_metric(s, "sharpe_ratio", asset_type="stock")
    return r.select("ticker", R("annualized_return"), R("annualized_volatility"), R("sharpe_ratio"))


@query("price_score_pairs", with_ctes(
    "SELECT code_commune, type_local, median_price_per_sqm, opportunity_score FROM commune_score"
    " WHERE median_price_per_sqm IS NOT NULL"))
def price_score_pairs(spark, sf):
    s = serving.price_score_pairs(Inputs(spark, sf).score)
    return s.select("code_commune", "type_local", "median_price_per_sqm", "opportunity_score")


@query("filter_options", with_ctes(
    "SELECT 'department' AS option_kind, code_departement AS option_value FROM commune_score"
    " WHERE code_departement IS NOT NULL GROUP BY code_departement UNION ALL "
    "SELECT 'property_type', type_local FROM commune_score WHERE type_local IS NOT NULL GROUP BY type_local"))
def filter_options(spark, sf):
    s = Inputs(spark, sf).score_table
    deps = serving.distinct_options(s, "code_departement").select(
        F.lit("department").alias("option_kind"), F.col("code_departement").alias("option_value"))
    types = serving.distinct_options(s, "type_local").select(
        F.lit("property_type").alias("option_kind"), F.col("type_local").alias("option_value"))
    return deps.unionByName(types)


def _best_sql(src: str, metric: str, key: str = "ticker") -> str:
    return f"(SELECT {key} FROM {src} WHERE {metric} IS NOT NULL ORDER BY {metric} DESC, {key} LIMIT 1)"


@query("group_kpis", with_ctes(f"""
SELECT e.*, a.*, c.*, m.* FROM
 (SELECT count(*) AS ticker_count, count(CASE WHEN asset_type = 'stock' THEN 1 END) AS stock_count,
         count(CASE WHEN asset_type = 'etf' THEN 1 END) AS etf_count,
         {r6('avg(annualized_return)')} AS avg_return,
         {r6("avg(CASE WHEN asset_type = 'stock' THEN annualized_return END)")} AS avg_return_stock,
         {r6("avg(CASE WHEN asset_type = 'etf' THEN annualized_return END)")} AS avg_return_etf,
         {r6('avg(annualized_volatility)')} AS avg_volatility,
         {_best_sql('equity_summary', 'annualized_return')} AS best_return_ticker,
         {_best_sql('equity_summary', 'sharpe_ratio')} AS best_sharpe_ticker
  FROM equity_summary) e
CROSS JOIN
 (SELECT count(*) AS alt_ticker_count, count(CASE WHEN liquidity = 'liquid' THEN 1 END) AS alt_liquid_count,
         {r6('avg(annualized_return)')} AS alt_avg_return, {r6('avg(annualized_volatility)')} AS alt_avg_volatility,
         {r6('avg(period_return_pct)')} AS alt_avg_period_return,
         {_best_sql('alt_summary', 'annualized_return')} AS alt_best_return_ticker,
         {_best_sql('alt_summary', 'sharpe_ratio')} AS alt_best_sharpe_ticker
  FROM alt_summary) a
CROSS JOIN
 (SELECT count(DISTINCT code_commune) AS commune_count,
         (SELECT nom_commune FROM commune_score WHERE opportunity_score IS NOT NULL
          ORDER BY opportunity_score DESC, code_commune, type_local LIMIT 1) AS top_commune,
         max(opportunity_score) AS top_score, max(national_median_price_per_sqm) AS national_median_price_per_sqm
  FROM commune_score) c
CROSS JOIN
 (SELECT {r6('national_median_income')} AS national_median_income,
         {r6('national_median_population')} AS national_median_population FROM {_NAT_SQL}) m"""))
def group_kpis(spark, sf):
    i = Inputs(spark, sf)
    e = serving.equity_kpis(i.equity_summary)
    a = serving.alternatives_kpis(i.alt_summary)
    a = a.select(*[F.col(c).alias(f"alt_{c}") for c in a.columns])
    c = serving.commune_kpis(i.score_table)
    j = attach_one_row(attach_one_row(e, a), c)
    rounded = ["avg_return", "avg_return_stock", "avg_return_etf", "avg_volatility", "alt_avg_return",
               "alt_avg_volatility", "alt_avg_period_return", "national_median_income", "national_median_population"]
    return j.select(*[R(c) if c in rounded else c for c in j.columns])


@query("ranked_communes", with_ctes("""
SELECT row_number() OVER (ORDER BY opportunity_score DESC NULLS LAST, code_commune, type_local) AS ordinal,
       code_commune, type_local, opportunity_score
FROM commune_score WHERE type_local = 'A'"""))
def ranked_communes(spark, sf):
    """D01 with its sort: the place of each commune of one type."""
    r = serving.ranked_communes(Inputs(spark, sf).score, property_type="A", enabled_types=["A", "R"])
    return r.select("ordinal", "code_commune", "type_local", "opportunity_score")


# 21 bars lie on both sides of the gate; a few weeks blown up to a year give numbers of any size, so logarithms are compared
UNGATED_DAYS = 21


def _ungated(spark, sf) -> Inputs:
    return Inputs(spark, sf, td.TEST_PARAMS.with_(min_trading_days_for_return=UNGATED_DAYS))


def _log_sql(c: str) -> str:
    return r6(f"CASE WHEN {c} < 0 THEN -ln(1 - {c}) ELSE ln(1 + {c}) END")


def _log(c: str):
    x = F.col(c)
    return F.round(F.when(x < 0, -F.log(F.lit(1.0) - x)).otherwise(F.log(F.lit(1.0) + x)), 6) + 0.0


@query("performance_ungated", with_ctes(
    "SELECT ticker, trading_days, first_price, last_price, "
    + ", ".join(f"{_log_sql(c)} AS log_{c}" for c in ("annualized_return", "annualized_volatility", "sharpe_ratio"))
    + ", max_drawdown_pct FROM alt_summary", min_days=UNGATED_DAYS))
def performance_ungated(spark, sf):
    """M18 on both sides of the gate: returns, volatility and ratio of the tickers that pass, nulls for the others."""
    s = _ungated(spark, sf).alt_summary
    logs = [_log(c).alias(f"log_{c}") for c in ("annualized_return", "annualized_volatility", "sharpe_ratio")]
    return s.select("ticker", "trading_days", "first_price", "last_price", *logs, "max_drawdown_pct")


_UNGATED_BLENDS = ["alternatives", "liquid"]


@query("alternatives_blends", with_ctes(
    "SELECT " + ", ".join(f"{_log_sql(f'{b}_annualized_{c}')} AS log_{b}_{c}" for b in _UNGATED_BLENDS for c in ("return", "volatility"))
    + ", alternatives_count, liquid_count, alternatives_method, liquid_method, "
    + r6(_clamp_sql("liquid_annualized_return", 0.2, 0.06)) + " AS alternatives_growth_rate, "
    + _log_sql("k.r") + " AS log_avg_return, " + _log_sql("k.v") + " AS log_avg_volatility, best_return_ticker, best_sharpe_ticker FROM (SELECT "
    + _blend_sql("alternatives", "true", 0.06, 0.35) + ", "
    + _blend_sql("liquid", "liquidity = 'liquid'", 0.06, 0.35)
    + " FROM alt_summary) b CROSS JOIN (SELECT avg(annualized_return) AS r, avg(annualized_volatility) AS v,"
    " (SELECT ticker FROM alt_summary WHERE annualized_return IS NOT NULL ORDER BY annualized_return DESC, ticker LIMIT 1) AS best_return_ticker,"
    " (SELECT ticker FROM alt_summary WHERE sharpe_ratio IS NOT NULL ORDER BY sharpe_ratio DESC, ticker LIMIT 1) AS best_sharpe_ticker"
    " FROM alt_summary) k", min_days=UNGATED_DAYS))
def alternatives_blends(spark, sf):
    """A18, D13 and D14 of the alternatives with tickers that pass the gate: no fallback constants."""
    i = _ungated(spark, sf)
    summary = materialize(i.alt_summary)
    blends = assumptions.alternatives_blends(summary, i.p)
    k = serving.alternatives_kpis(summary).select(
        F.col("avg_return").alias("k_return"), F.col("avg_volatility").alias("k_volatility"),
        "best_return_ticker", "best_sharpe_ticker")
    j = attach_one_row(blends, k)
    rate = assumptions.clamp_or_fallback(F.col("liquid_annualized_return"), i.p.blended_return_limit, i.p.alternatives_fallback_return)
    return j.select(
        *[_log(f"{b}_annualized_{c}").alias(f"log_{b}_{c}") for b in _UNGATED_BLENDS for c in ("return", "volatility")],
        "alternatives_count", "liquid_count", "alternatives_method", "liquid_method",
        F.round(rate, 6).alias("alternatives_growth_rate"),
        _log("k_return").alias("log_avg_return"), _log("k_volatility").alias("log_avg_volatility"),
        "best_return_ticker", "best_sharpe_ticker")


_ORDERED = {  # mart: metric, keys
    "commune_opportunity_score": ("commune_score", "opportunity_score", ("code_commune", "type_local")),
    "department_opportunity_score": ("dept_score", "median_opportunity_score", ("code_departement",)),
    "equity_performance_summary": ("equity_summary", "annualized_return", ("ticker",)),
    "alternatives_performance_summary": ("alt_summary", "annualized_return", ("ticker",)),
}


@query("mart_order", with_ctes(" UNION ALL ".join(
    f"SELECT '{mart}' AS mart, concat_ws('|', {', '.join(keys)}) AS key, {metric} IS NULL AS missing,"
    f" row_number() OVER (ORDER BY {metric} DESC NULLS LAST, {', '.join(keys)}) AS ordinal FROM {cte}"
    for mart, (cte, metric, keys) in _ORDERED.items()), min_days=UNGATED_DAYS))
def mart_order(spark, sf):
    """The place of every row in each mart's published order, rows without a metric last."""
    from cadastra.operators.ordinal import by_metric, with_ordinal

    i = _ungated(spark, sf)
    marts = dict(zip(_ORDERED, (i.score_table, i.dept_score, i.equity_summary, i.alt_summary)))
    return landing.union_frames([
        with_ordinal(marts[mart], by_metric(metric, *keys)).select(
            F.lit(mart).alias("mart"), F.concat_ws("|", *keys).alias("key"), F.col(metric).isNull().alias("missing"), "ordinal")
        for mart, (_, metric, keys) in _ORDERED.items()])


@query("strict_casts", """
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate, CASE l_linenumber
    WHEN 1 THEN CAST(year(l_shipdate) AS VARCHAR) WHEN 2 THEN strftime(l_shipdate, '%Y-%m')
    WHEN 3 THEN CAST(l_partkey AS VARCHAR) || 'd' WHEN 4 THEN '   ' WHEN 5 THEN '+' || CAST(l_partkey AS VARCHAR)
    WHEN 6 THEN ' -' || CAST(l_partkey AS VARCHAR) || '.5 ' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS raw
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, raw,
  CASE WHEN l_linenumber >= 7 THEN CAST(l_shipdate AS DATE) END AS as_date,
  CASE l_linenumber WHEN 1 THEN CAST(year(l_shipdate) AS DOUBLE) WHEN 5 THEN CAST(l_partkey AS DOUBLE)
    WHEN 6 THEN -(l_partkey + CAST(0.5 AS DOUBLE)) END AS as_double,
  CASE l_linenumber WHEN 1 THEN CAST(year(l_shipdate) AS BIGINT) WHEN 5 THEN CAST(l_partkey AS BIGINT) END AS as_bigint
FROM t""")
def strict_casts(spark, sf):
    """Texts that are no date or number (a year, a month, a suffix, blanks, signs) over the whole table."""
    from cadastra.operators.staging import strict_cast

    part, n = F.col("l_partkey").cast("string"), F.col("l_linenumber")
    raw = (F.when(n == 1, F.date_format("l_shipdate", "yyyy")).when(n == 2, F.date_format("l_shipdate", "yyyy-MM"))
           .when(n == 3, F.concat(part, F.lit("d"))).when(n == 4, F.lit("   ")).when(n == 5, F.concat(F.lit("+"), part))
           .when(n == 6, F.concat(F.lit(" -"), part, F.lit(".5 "))).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")))
    t = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", raw.alias("raw"))
    return t.select("*", *[strict_cast(t, "raw", to).alias(f"as_{to}") for to in ("date", "double", "bigint")])


# --- quality and coverage --------------------------------------------------------------------------------
# fixed values: the columns declared not null, by table
NOT_NULL = {
    "sales": ("id_mutation", "code_commune", "valeur_fonciere"),
    "equity_prices": ("ticker", "date"),
    "alt_prices": ("ticker", "date"),
    "population": ("code_insee",),
    "income": ("code_insee",),
    "population_history": ("code_insee", "year"),
    "tax": ("code_commune", "year"),
    "commune_score": ("code_commune", "opportunity_score"),
    "dept_score": ("code_departement",),
    "equity_summary": ("ticker",),
    "alt_summary": ("ticker",),
}


def _checks() -> list[quality.Check]:
    C = quality.Check
    return [
        *[C(t, "not_null", (c,)) for t, cols in NOT_NULL.items() for c in cols],
        C("population", "unique", ("code_insee",)),
        C("income", "unique", ("code_insee",)),
        C("dept_score", "unique", ("code_departement",)),
        C("equity_summary", "unique", ("ticker",)),
        C("alt_summary", "unique", ("ticker",)),
        C("equity_prices", "unique_combination", ("ticker", "date")),
        C("alt_prices", "unique_combination", ("ticker", "date")),
        C("commune_score", "unique_combination", ("code_commune", "type_local", "year")),
        C("equity_prices", "relationship", ("ticker",), "equity_watchlist", "ticker"),
        C("alt_prices", "relationship", ("ticker",), "alt_watchlist", "ticker"),
        C("sales", "relationship", ("id_mutation",), "orders", "order_id"),
    ]


def _check_sql() -> str:
    parts = []
    src = {
        "sales": "(SELECT CAST(l_orderkey AS VARCHAR) AS id_mutation, CAST(l_suppkey AS VARCHAR) AS code_commune,"
                 " l_extendedprice AS valeur_fonciere FROM stg_tx)",
        "population": "population", "income": "income", "population_history": "pop_hist", "tax": "tax",
        "alt_summary": "alt_summary", "dept_score": "dept_score", "equity_summary": "equity_summary",
        "equity_prices": "eq_prices", "alt_prices": "alt_prices", "commune_score": "commune_score",
        "equity_watchlist": "eq_watch", "alt_watchlist": "alt_watch",
        "orders": "(SELECT CAST(o_orderkey AS VARCHAR) AS order_id FROM orders)",
    }
    for c in _checks():
        t = src[c.table]
        if c.kind == "not_null":
            q = f"SELECT count(*) FROM {t} WHERE {c.columns[0]} IS NULL"
        elif c.kind in ("unique", "unique_combination"):
            cols = ", ".join(c.columns)
            w = f"WHERE {c.columns[0]} IS NOT NULL" if c.kind == "unique" else ""
            q = f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {t} {w} GROUP BY {cols}) WHERE n > 1"
        else:
            k = c.columns[0]
            q = (f"SELECT count(*) FROM {t} x WHERE x.{k} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {src[c.ref_table]} r WHERE r.{c.ref_column} = x.{k})")
        parts.append(f"SELECT '{c.name}' AS \"check\", CAST(({q}) AS BIGINT) AS failing_rows")
    return with_ctes("SELECT *, failing_rows = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")")


@query("quality_report", _check_sql())
def quality_report(spark, sf):
    i = Inputs(spark, sf)
    # the marts read the sales and bars as well: deduped once, and written with the columns that either needs
    i.sales = materialize(i.sales.select(
        "id_mutation", "nature_mutation", "valeur_fonciere", "code_commune", "nom_commune", "code_departement", "type_local",
        "surface_reelle_bati", "source_year"))
    i.equity_prices = materialize(i.equity_prices.select("ticker", "date", "adj_close", "dividends"))
    i.alt_prices = materialize(i.alt_prices.select("ticker", "date", "adj_close"))
    orders = td.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"))
    tables = {
        "sales": i.sales, "population": i.population, "income": i.income, "dept_score": i.dept_score,
        "population_history": i.population_history, "tax": i.tax, "alt_summary": i.alt_summary,
        "equity_summary": i.equity_summary, "equity_prices": i.equity_prices, "alt_prices": i.alt_prices,
        "commune_score": i.score_table, "equity_watchlist": i.equity_watchlist, "alt_watchlist": i.alt_watchlist,
        "orders": orders,
    }
    return quality.run_checks(tables, _checks())


@query("coverage_audit", with_ctes("""
SELECT d.code_departement, CAST(y.year AS INTEGER) AS year, CAST(coalesce(c.n, 0) AS BIGINT) AS rows_landed,
       c.n IS NOT NULL AS landed
FROM depts d CROSS JOIN (SELECT unnest(range(min(year(l_shipdate)) - 1, max(year(l_shipdate)) + 1)) AS year FROM raw_tx) y
LEFT JOIN (SELECT CAST(s_nationkey AS VARCHAR) AS dep, CAST(year(l_shipdate) AS INTEGER) AS yr, count(*) AS n
           FROM raw_tx GROUP BY 1, 2) c
  ON c.dep = d.code_departement AND c.yr = y.year"""))
def coverage_audit(spark, sf):
    i = Inputs(spark, sf)
    raw = td.raw_transactions(spark, sf)
    # from one year before the data starts (every pair of it is missing) to its last year
    first, last = raw.agg(F.min("source_year") - 1, F.max("source_year")).first()
    expected = quality.expected_partitions(i.departments, first, last)
    audit = materialize(quality.coverage_audit(expected, raw))  # departments x years: read twice
    quality.assert_some_landed(audit)
    return audit


# --- landing ---------------------------------------------------------------------------------------------
@query("wide_to_long_bars", "SELECT event_id, event_type AS ticker, value FROM events"
       " WHERE value IS NOT NULL AND NOT isnan(value) AND event_type IS NOT NULL")
def wide_to_long_bars(spark, sf):
    ev = td.table(spark, sf, "events")
    # one wide column per type: the types are the columns of a delivered file, so they are few
    types = sorted(r[0] for r in ev.where("event_type IS NOT NULL").select("event_type").distinct().collect())
    wide = ev.select("event_id", *[F.when(F.col("event_type") == t, F.col("value")).alias(f"value|{t}")
                                   for t in types])
    longf = landing.wide_to_long(wide, "event_id", ["value"], types)
    return longf.select("event_id", "ticker", "value")


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "cadastra", name)


@query("csv_landing_sales", with_ctes(
    "SELECT CAST(l_orderkey AS VARCHAR) AS id_mutation, CAST(l_linenumber AS VARCHAR) AS numero_disposition,"
    " CAST(l_extendedprice AS VARCHAR) AS valeur_fonciere, CAST(s_nationkey AS VARCHAR) AS source_departement,"
    " CAST(year(l_shipdate) AS INTEGER) AS source_year FROM raw_tx"))
def csv_landing_sales(spark, sf):
    """Round trip through delivered-file layout: gzip CSV per (year, department)."""
    import uuid

    root = _scratch(spark, f"landing-{uuid.uuid4().hex}")
    raw = td.raw_transactions(spark, sf).select(
        F.col("id_mutation").alias("Id Mutation"), F.col("numero_disposition").alias("Numéro Disposition"),
        F.col("valeur_fonciere").alias("Valeur Foncière"),
        F.col("source_year").alias("year"), F.col("source_departement").alias("dep"),
    )
    # few files per (year, department), as the source publishes them; the rebalance hint
    # lets AQE split a pair that holds a large share of the rows over several tasks
    n = parallelism(spark)
    raw.hint("rebalance", n, "year", "dep").write.partitionBy("year", "dep").option("header", True) \
        .option("compression", "gzip").csv(root)
    got = landing.read_sales_csv(spark, root, layout="hive")
    return got.select("id_mutation", F.col("numero_disposition"), "valeur_fonciere",
                      "source_departement", "source_year")


@query("delimited_reference_income", with_ctes(
    "SELECT code_insee, nom_commune, median_disposable_income FROM income"))
def delimited_reference_income(spark, sf):
    """S04-S06 + M05: a ';' latin-1 reference file with accented headers, read back."""
    import uuid

    from cadastra.operators.staging import stg_income

    path = _scratch(spark, f"income-{uuid.uuid4().hex}")
    raw = td.raw_income(spark, sf).select(
        F.col("code_geographique").alias("CODGEO"),
        F.col("libelle_geographique").alias("Libellé géographique"),
        F.col("disp_mediane").alias("Disp. médiane"),
    )
    raw.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    got = landing.read_delimited(spark, path)  # the header line is no utf-8, so its file is latin-1
    staged = stg_income(got.select(
        F.col("codgeo").alias("code_geographique"),
        F.col("libelle_geographique"),
        F.col("disp_mediane"),
    ))
    return staged.select("code_insee", "nom_commune", "median_disposable_income")


def _fresh(spark: SparkSession, name: str) -> str:
    import uuid

    return _scratch(spark, f"{name}-{uuid.uuid4().hex}")


_MIXED = """
SELECT code_insee, nom_commune, median_disposable_income, encoding FROM (
  SELECT code_insee, nom_commune || CASE encoding WHEN 'ascii' THEN '' ELSE ' été Ã©' END AS nom_commune,
         median_disposable_income, encoding
  FROM income, (VALUES ('utf-8'), ('latin-1'), ('ascii')) e(encoding))"""


@query("mixed_encodings", with_ctes(_MIXED))
def mixed_encodings(spark, sf):
    """Files of two encodings and delimiters in one folder, each told by its own bytes.

    The names hold a pair of letters that is also valid utf-8, so only a file's
    other values give it away.
    """
    from cadastra.operators.staging import stg_income

    root = _fresh(spark, "mixed")
    raw = td.raw_income(spark, sf)
    kinds = {"utf-8": ("UTF-8", ";"), "latin-1": ("ISO-8859-1", ","), "ascii": ("UTF-8", ",")}
    for name, (charset, sep) in kinds.items():
        label = F.col("libelle_geographique")
        label = label if name == "ascii" else F.concat(label, F.lit(" été Ã©"))
        raw.select(F.col("code_geographique").alias("Code Géographique" if name != "ascii" else "code_geographique"),
                   label.alias("libelle_geographique"), F.lit(name).alias("Encoding"),
                   F.col("disp_mediane").alias("Disp. médiane" if name != "ascii" else "disp_mediane")).write.options(
            header=True, sep=sep, encoding=charset).csv(f"{root}/{name}")
    got = landing.read_delimited(spark, f"{root}/*")
    staged = [stg_income(got.where(F.col("encoding") == name)).withColumn("encoding", F.lit(name)) for name in kinds]
    return landing.union_frames(staged).select("code_insee", "nom_commune", "median_disposable_income", "encoding")


@query("landed_marts", SQL["opportunity_score"])
def landed_marts(spark, sf):
    """The commune mart from delivered files alone.

    The test tables are written as their sources publish them, landed into a
    store in two loads, and the mart is built from the store and the seeds.
    """
    from cadastra.plans import landed

    delivered, root = _fresh(spark, "delivered"), _fresh(spark, "store")
    landed.deliver(spark, sf, delivered)
    raw = td.raw_transactions(spark, sf)
    first, last = raw.agg(F.min("source_year"), F.max("source_year")).first()
    landed.land(spark, delivered, root, quality.expected_partitions(td.departments(spark, sf), first, last))
    # the seeds were delivered beside the files
    inputs = landed.LandedInputs(spark, root, td.TEST_PARAMS)
    inputs.__dict__["departments"] = landing.read_delimited(spark, f"{delivered}/seeds/departements")
    return _score_cols(inputs.score)


_REPORT_YEAR = 1996  # fixed values of the fixture: one year, a department for each kind of file
_REPORT = {"damaged": "3", "empty": "4", "missing": "5"}


@query("load_report", with_ctes(f"""
SELECT d.code_departement, CAST(y.year AS INTEGER) AS year,
  CASE WHEN y.year = {_REPORT_YEAR} AND d.code_departement = '3' THEN 'damaged'
       WHEN y.year = {_REPORT_YEAR} AND d.code_departement = '4' THEN 'empty'
       WHEN y.year = {_REPORT_YEAR} AND d.code_departement = '5' OR c.n IS NULL THEN 'missing' ELSE 'landed' END AS status,
  CAST(CASE WHEN y.year = {_REPORT_YEAR} AND d.code_departement IN ('3', '4', '5') THEN 0 ELSE coalesce(c.n, 0) END AS BIGINT)
    AS rows_landed
FROM depts d CROSS JOIN (SELECT unnest(range(min(year(l_shipdate)) - 1, max(year(l_shipdate)) + 1)) AS year FROM raw_tx) y
LEFT JOIN (SELECT CAST(s_nationkey AS VARCHAR) AS dep, CAST(year(l_shipdate) AS INTEGER) AS yr, count(*) AS n
           FROM raw_tx GROUP BY 1, 2) c ON c.dep = d.code_departement AND c.yr = y.year"""))
def load_report(spark, sf):
    """One damaged, one empty and one missing file beside the others; all others land."""
    from cadastra.plans import landed
    from cadastra.sources.store import RawStore, land_sales

    delivered, root = _fresh(spark, "delivered"), _fresh(spark, "store")
    raw = td.raw_transactions(spark, sf)
    first, last = raw.agg(F.min("source_year") - 1, F.max("source_year")).first()
    odd = (F.col("source_year") == _REPORT_YEAR) & F.col("source_departement").isin(*_REPORT.values())
    landed.deliver_sales(raw.where(~odd), delivered)
    for kind, data in {"damaged": landed.cut_short(), "empty": b""}.items():
        landed.put_bytes(spark, f"{delivered}/year={_REPORT_YEAR}/dep={_REPORT[kind]}/part.csv.gz", data)
    report = land_sales(RawStore(spark, root), delivered, quality.expected_partitions(td.departments(spark, sf), first, last),
                        *landed.FIRST_LOAD, layout="hive")
    return report.select("code_departement", "year", "status", "rows_landed")


@query("export_manifest", with_ctes(
    "SELECT 'commune_opportunity_score' AS mart, (SELECT count(*) FROM commune_score) AS row_count UNION ALL "
    "SELECT 'department_opportunity_score', (SELECT count(*) FROM dept_score) UNION ALL "
    "SELECT 'equity_performance_summary', (SELECT count(*) FROM equity_summary) UNION ALL "
    "SELECT 'alternatives_performance_summary', (SELECT count(*) FROM alt_summary)"))
def export_manifest(spark, sf):
    from cadastra.sources.export import manifest

    i = Inputs(spark, sf)
    return manifest({
        "commune_opportunity_score": i.score_table, "department_opportunity_score": i.dept_score,
        "equity_performance_summary": i.equity_summary, "alternatives_performance_summary": i.alt_summary,
    })


_EXPORTED_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)  # fixed value: the clock of the compared export


@query("export_document", with_ctes(f"""
SELECT 'pea_eligible' AS list, row_number() OVER (ORDER BY ticker) - 1 AS place, ticker AS code, name, asset_type AS kind,
  {r6('annualized_return')} AS first_value, {r6('annualized_volatility')} AS second_value FROM equity_summary WHERE pea_eligible = true
UNION ALL SELECT 'watchlist', row_number() OVER (ORDER BY ticker) - 1, ticker, name,
  concat_ws('/', asset_class, instrument_type, liquidity), {r6('annualized_return')}, {r6('annualized_volatility')} FROM alt_summary
UNION ALL SELECT 'by_department', row_number() OVER (ORDER BY code_departement) - 1, code_departement, nom_departement, NULL,
  {r6('median_price_cagr')}, NULL FROM dept_score WHERE median_price_cagr IS NOT NULL
UNION ALL SELECT 'header', 0, '2024-02-01T00:00:00+00:00', equity_method, liquid_method, national_median_price_cagr,
  pea_growth_rate FROM ({_BLEND_SELECT})"""))
def export_document(spark, sf):
    """The written document, read back, parsed line by line, and its lists told apart again."""
    from cadastra.sources import document

    i = Inputs(spark, sf)
    path = _fresh(spark, "document")
    equity, alts = materialize(i.equity_summary), materialize(i.alt_summary)
    document.write(document.lines(equity, alts, i.dept_score, _EXPORTED_AT, i.p), path)
    doc = document.read(spark, path)

    def rows(name, part, kind, first, second):
        return document.rows(doc, part).select(
            F.lit(name).alias("list"), "place",
            F.coalesce(*[F.col(f"x.{c}") for c in (("code_departement",) if name == "by_department" else ("ticker",))]).alias("code"),
            F.col("x.nom_departement" if name == "by_department" else "x.name").alias("name"), kind.alias("kind"),
            F.round(first, 6).alias("first_value"), F.round(second, 6).alias("second_value"))

    header = document.header(doc).select(
        F.lit("header").alias("list"), F.lit(0).cast("bigint").alias("place"), F.col("exported_at").alias("code"),
        F.col("equities.blended_default.method").alias("name"), F.col("alternatives.liquid_blended_default.method").alias("kind"),
        F.round("real_estate.national_median_price_cagr", 6).alias("first_value"),
        F.round("growth.pea_growth_rate", 6).alias("second_value"))
    ret, vol = F.col("x.annualized_return"), F.col("x.annualized_volatility")
    return landing.union_frames([
        rows("pea_eligible", 1, F.col("x.asset_type"), ret, vol),
        rows("watchlist", 3, F.concat_ws("/", "x.asset_class", "x.instrument_type", "x.liquidity"), ret, vol),
        rows("by_department", 5, F.lit(None).cast("string"), F.col("x.median_price_cagr"), F.lit(None).cast("double")),
        header])


# --- streaming -------------------------------------------------------------------------------------------
@query("incremental_latest_wins", SQL["latest_wins_bars"])
def incremental_latest_wins(spark, sf):
    """R01 over the short bars: deliveries land in two runs, out of time order."""
    import uuid

    from cadastra.operators.staging import stg_prices
    from cadastra.streaming import incremental

    base = _scratch(spark, f"stream-{uuid.uuid4().hex}")
    raw = td.raw_alternative_prices(spark, sf)
    raw = raw.withColumn("_tb_event", F.col("_tiebreak.event_id")).drop("_tiebreak")
    order = [F.col("_ingested_at").desc(), F.col("_tb_event").desc()]
    schema, keys = raw.schema, ["ticker", "date"]
    # two deliveries: the odd event ids first, then the even ones; every row lands once
    for k, odd in enumerate((1, 0)):
        raw.where(F.pmod("_tb_event", F.lit(2)) == odd).write.mode("overwrite").parquet(f"{base}/landing/delivery={k}")
        incremental.start(spark, f"{base}/landing/*", schema, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return stg_prices(incremental.read_current(spark, f"{base}/table", schema, keys, order), order).select(*BAR_COLS)


@query("merged_latest_wins", SQL["latest_wins_bars"])
def merged_latest_wins(spark, sf):
    """R01 as a merge: two deliveries, each merged into the months it touches; reading ranks nothing."""
    from cadastra.operators.staging import stg_prices
    from cadastra.streaming import incremental

    base = _fresh(spark, "merge")
    raw = td.raw_alternative_prices(spark, sf)
    raw = raw.withColumn("_tb_event", F.col("_tiebreak.event_id")).drop("_tiebreak")
    order = [F.col("_ingested_at").desc(), F.col("_tb_event").desc()]
    for k, odd in enumerate((1, 0)):
        raw.where(F.pmod("_tb_event", F.lit(2)) == odd).write.mode("overwrite").parquet(f"{base}/landing/delivery={k}")
        incremental.start_merge(spark, f"{base}/landing/*", raw.schema, f"{base}/table", f"{base}/checkpoint", ["ticker", "date"],
                                order, F.date_format("date", "yyyy-MM")).awaitTermination()
    # one row per key already: staging's own dedupe finds nothing to drop
    return stg_prices(incremental.read_merged(spark, f"{base}/table", raw.schema), order).select(*BAR_COLS)


# --- null keys -------------------------------------------------------------------------------------------
def _null_key_sales(spark, sf):
    """Sales per (supplier or null, flag, year or null): every fifth supplier and every year after 1997 is null."""
    li = td.table(spark, sf, "lineitem")
    return li.select(
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey").cast("string")).alias("code_commune"),
        F.col("l_returnflag").alias("type_local"),
        F.when(F.year("l_shipdate") <= 1997, F.year("l_shipdate")).alias("year"), "l_extendedprice")


_NULL_KEYS = """
WITH v AS (
  SELECT CASE WHEN l_suppkey % 5 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS code_commune, l_returnflag AS type_local,
         CASE WHEN year(l_shipdate) <= 1997 THEN CAST(year(l_shipdate) AS INTEGER) END AS year, l_extendedprice
  FROM lineitem),
m AS (
  SELECT code_commune, type_local, year, count(*) AS n, CAST(quantile_disc(l_extendedprice, 0.5) AS DOUBLE) AS median
  FROM v GROUP BY code_commune, type_local, year)
"""


@query("median_null_groups", _NULL_KEYS + "SELECT route, m.* FROM m, (VALUES ('all in one'), ('sized'), ('bracket')) r(route)")
def median_null_groups(spark, sf):
    """A03 with null group keys, by each route of the median."""
    from cadastra.operators.median import agg_with_lower_median

    rows = _null_key_sales(spark, sf)
    routes = {"all in one": {"max_rows": 1, "max_exact_group": 1}, "sized": {"max_exact_group": 1 << 40}, "bracket": {"max_exact_group": 20}}
    out = None
    for name, how in routes.items():
        m = agg_with_lower_median(rows, ["code_commune", "type_local", "year"], "l_extendedprice", "median",
                                  extra_aggs=[F.count(F.lit(1)).alias("n")], **how).withColumn("route", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out.select("route", "code_commune", "type_local", "year", "n", "median")


@query("period_stats_null_keys", _NULL_KEYS + """
SELECT cur.*, prev.median AS prior FROM m cur LEFT JOIN m prev
  ON cur.code_commune = prev.code_commune AND cur.type_local = prev.type_local AND cur.year = prev.year + 1""")
def period_stats_null_keys(spark, sf):
    """J01 with null communes and years: no prior year for either."""
    from cadastra.params import DEFAULT

    sales = _null_key_sales(spark, sf).select(
        "code_commune", F.lit("x").alias("nom_commune"), F.lit("d").alias("code_departement"), "type_local",
        F.col("year").alias("source_year"), F.lit("Vente").alias("nature_mutation"),
        F.col("l_extendedprice").alias("valeur_fonciere"), F.lit(1.0).alias("surface_reelle_bati"))
    flags = [r[0] for r in sales.select("type_local").distinct().collect()]  # the table's return flags: three
    p = dataclasses.replace(DEFAULT, property_types=tuple(flags), min_price_per_sqm=float("-inf"), max_price_per_sqm=float("inf"))
    return places.period_stats(sales, p).select(
        "code_commune", "type_local", "year", F.col("transaction_count").alias("n"),
        F.col("median_price_per_sqm").alias("median"), F.col("prior_year_median_price_per_sqm").alias("prior"))
