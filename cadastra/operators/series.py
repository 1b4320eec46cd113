"""Price-series branch: daily returns and per-instrument performance.

M13/M14 daily_returns, A08 end prices, M17 equity and M18 alternatives
performance summaries, K11/K12 benchmark-aligned excess return.

All windows share one spec (ticker, date): Spark plans a single exchange and
sort for lag, rolling stddev and running max. A ticker's partition holds one
row per trading day after dedupe, so its size is bounded by the calendar,
not by the data volume.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.safe import safe_div, safe_pow
from cadastra.operators.joins import attach_one_row
from cadastra.operators.materialize import materialize
from cadastra.operators.median import disc_median
from cadastra.params import DEFAULT, Params


_MAX_PLACES = 16  # end prices that are kept in columns of their own


def _by_ticker():
    return Window.partitionBy("ticker").orderBy("date")


def _end_median(px: str, place: Column, k: int) -> Column:
    """Lower median of ``px``, null but in the rows at places 1 to ``k`` of a group (one row each), as an aggregate.

    ``percentile_disc`` keeps an object per group and has Spark sort all rows
    by group once more; the greatest price at each place is a plain number.
    """
    if k > _MAX_PLACES:
        return disc_median(px)
    v = F.col(px).cast("double")
    found = F.array_sort(F.array_compact(F.array(*[F.max(F.when(place == i, v)) for i in range(1, k + 1)])))
    return F.get(found, F.floor((F.size(found) - 1) / F.lit(2)).cast("int"))


def _end_prices(k: int) -> tuple[Column, Column]:
    """First and last price of a group from the flags of ``_with_end_flags``."""
    return _end_median("_first_px", F.col("_rn"), k), _end_median("_last_px", F.col("_n") - F.col("_rn") + 1, k)



def _returns(prices: DataFrame, p: Params, carry: Sequence[str] = ()) -> DataFrame:
    prev = F.lag("adj_close").over(_by_ticker())
    r = prices.select("ticker", "date", "adj_close", *carry,
                      safe_div(F.col("adj_close") - prev, prev).alias("daily_return"))
    trail = _by_ticker().rowsBetween(-(p.volatility_window_rows - 1), Window.currentRow)
    upto = _by_ticker().rowsBetween(Window.unboundedPreceding, Window.currentRow)  # ROWS, not RANGE
    peak = F.max("adj_close").over(upto)
    return r.select(
        "ticker",
        "date",
        "adj_close",
        "daily_return",
        F.stddev_samp("daily_return").over(trail).alias("rolling_30d_volatility"),
        safe_div(F.col("adj_close") - peak, peak).alias("drawdown_pct"),
        *carry,
    )


def daily_returns(prices: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Return vs previous bar, trailing 30-row volatility, drawdown."""
    return _returns(prices, p)


def _mark_inside(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """``_in``: 1 for the bars inside a one-row benchmark window (broadcast), else 0."""
    inside = F.coalesce(F.col("date").between(F.col("_b_first"), F.col("_b_last")), F.lit(False))
    return attach_one_row(df, bounds, "left").withColumn("_in", inside.cast("int")).drop("_b_first", "_b_last")


def _with_end_flags(df: DataFrame, p: Params) -> DataFrame:
    """Flags for the first / last ``end_price_rows`` bars of each ticker.

    (ticker, date) is unique, so the rank from the end is n - rn + 1: one
    sort. When ``df`` is marked by ``_mark_inside``, the same flags are also
    computed over the marked bars (running count of them). All counts name the
    order of the returns, and the marks are there before them: Spark runs all
    windows of a ticker in one pass.
    """
    w = _by_ticker()
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    k = p.end_price_rows
    marked = "_in" in df.columns
    counts = [F.row_number().over(w).alias("_rn"), F.count(F.lit(1)).over(whole).alias("_n")]
    if marked:
        counts += [F.sum("_in").over(upto).alias("_rn_in"), F.sum("_in").over(whole).alias("_n_in")]
    d = df.select("*", *counts)
    d = d.withColumn("_first_px", F.when(F.col("_rn") <= k, F.col("adj_close"))).withColumn(
        "_last_px", F.when(F.col("_n") - F.col("_rn") + 1 <= k, F.col("adj_close"))
    )
    if not marked:
        return d
    return d.withColumn("_first_in", F.when((F.col("_in") == 1) & (F.col("_rn_in") <= k), F.col("adj_close"))).withColumn(
        "_last_in", F.when((F.col("_in") == 1) & (F.col("_n_in") - F.col("_rn_in") + 1 <= k), F.col("adj_close"))
    )


def end_prices(returns: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Lower median of the first and of the last five bars per ticker."""
    first, last = _end_prices(p.end_price_rows)
    return _with_end_flags(returns, p).groupBy("ticker").agg(first.alias("first_price"), last.alias("last_price"))


def benchmark_window(returns: DataFrame, p: Params) -> DataFrame:
    """One row: the benchmark's first and last date (nulls when it is absent)."""
    return returns.where(F.col("ticker") == p.benchmark_ticker).agg(
        F.min("date").alias("_b_first"), F.max("date").alias("_b_last")
    )


def _aligned(p: Params) -> F.Column:
    """K11 from the in-window flags: geometric annualisation over the window."""
    k = p.end_price_rows
    last = _end_median("_last_in", F.col("_n_in") - F.col("_rn_in") + 1, k)
    return safe_pow(
        safe_div(last, _end_median("_first_in", F.col("_rn_in"), k)),
        F.lit(p.trading_days_per_year) / F.max("_n_in"),
    ) - F.lit(1.0)


def _per_ticker(returns: DataFrame, p: Params, with_dividends: bool, aligned: bool = False) -> DataFrame:
    d = _with_end_flags(returns, p)
    n = F.count(F.lit(1))
    gate = n >= p.min_trading_days_for_return
    first, last = _end_prices(p.end_price_rows)
    aggs = [
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        first.alias("first_price"),
        last.alias("last_price"),
        n.alias("trading_days"),
        F.avg("daily_return").alias("avg_daily_return"),
        F.when(gate, F.stddev_samp("daily_return") * F.lit(math.sqrt(p.trading_days_per_year))).alias(
            "annualized_volatility"
        ),
        F.when(gate, safe_pow(safe_div(last, first), F.lit(p.trading_days_per_year) / n) - F.lit(1.0)).alias(
            "annualized_return"
        ),
        F.when(gate, F.min("drawdown_pct")).alias("max_drawdown_pct"),
    ]
    if with_dividends:
        aggs.append(F.sum("dividends").alias("total_dividends"))
    if aligned:
        aggs.append(F.when(F.max("_n_in") >= p.min_trading_days_for_return, _aligned(p))
                    .alias("aligned_annualized_return"))
    return d.groupBy("ticker").agg(*aggs)


def aligned_returns(returns: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Annualised return of each ticker over the benchmark's date window.

    Kept only for tickers with at least ``min_trading_days_for_return`` bars
    in the window; empty when the benchmark has no bars.
    """
    d = _with_end_flags(_mark_inside(returns, benchmark_window(returns, p)), p)
    g = d.groupBy("ticker").agg(_aligned(p).alias("aligned_annualized_return"),
                                F.max("_n_in").alias("_n_days"))
    return g.where(F.col("_n_days") >= p.min_trading_days_for_return).select("ticker", "aligned_annualized_return")


def _summary_core(t: DataFrame, p: Params) -> list:
    return [
        "first_date",
        "last_date",
        "first_price",
        "last_price",
        safe_div(F.col("last_price") - F.col("first_price"), F.col("first_price")).alias("period_return_pct"),
        "trading_days",
        "avg_daily_return",
        "annualized_volatility",
        "annualized_return",
        "max_drawdown_pct",
        safe_div(F.col("annualized_return") - F.lit(p.risk_free_rate_pct), F.col("annualized_volatility")).alias(
            "sharpe_ratio"
        ),
    ]


def equity_performance_summary(prices: DataFrame, watchlist: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """One row per ticker, gated risk/return, excess return, dividends.

    The benchmark window is a one-row relation computed first; returns, end
    prices and the in-window flags then share one window pass and one
    aggregate per ticker. The per-ticker table (one row per ticker) is
    written once because the benchmark's own row is read back from it.
    """
    bounds = benchmark_window(prices, p)
    r = _returns(_mark_inside(prices, bounds), p, carry=("dividends", "_in"))
    t = materialize(_per_ticker(r, p, with_dividends=True, aligned=True))
    bench = t.where(F.col("ticker") == p.benchmark_ticker).select(
        F.col("aligned_annualized_return").alias("benchmark_annualized_return")
    )
    wl = watchlist.select("ticker", "name", "asset_type", "sector", "isin", "pea_eligible")
    j = attach_one_row(t.join(wl, "ticker", "left"), bench, how="left")  # empty benchmark keeps every row
    return j.select(
        "ticker",
        "name",
        "asset_type",
        "sector",
        "isin",
        F.substring("isin", 1, 2).alias("country"),
        "pea_eligible",
        *_summary_core(j, p),
        (F.col("aligned_annualized_return") - F.col("benchmark_annualized_return")).alias(
            "relative_performance_vs_benchmark"
        ),
        "total_dividends",
        safe_div(F.col("total_dividends"), F.col("last_price")).alias("dividend_yield_pct"),
    )


def alternatives_performance_summary(prices: DataFrame, watchlist: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The equity summary without benchmark, ISIN and dividends."""
    r = _returns(prices, p)
    t = _per_ticker(r, p, with_dividends=False)
    wl = watchlist.select("ticker", "name", "asset_class", "instrument_type", "liquidity")
    j = t.join(wl, "ticker", "left")
    return j.select(
        "ticker", "name", "asset_class", "instrument_type", "liquidity", *_summary_core(j, p)
    )
