"""Lazily built staged tables and marts over one test-data folder.

Small per-group intermediates reused by several marts (period stats) are
checkpointed once to the shared checkpoint folder; everything else stays a
lazy DataFrame so Catalyst plans each query whole.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cadastra.operators import places, series
from cadastra.operators.materialize import materialize
from cadastra.operators.staging import (
    stg_income,
    stg_population,
    stg_population_history,
    stg_prices,
    stg_property_tax,
    stg_transactions,
)
from cadastra.params import Params
from cadastra.sources import testdata as td


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params | None = None):
        self.spark, self.sf, self.p = spark, sf_dir, params or td.TEST_PARAMS

    # ---- staging ---------------------------------------------------------
    @cached_property
    def sales(self) -> DataFrame:
        rows = td.sales_rows(self.spark, self.sf)
        return stg_transactions(rows, td.row_order(), td.SALES_ROW_KEY, td.as_raw_transactions)

    @cached_property
    def equity_prices(self) -> DataFrame:
        rows = td.bar_rows(self.spark, self.sf)
        return stg_prices(rows, td.bar_row_order(), td.BAR_ROW_KEY, td.as_raw_equity_prices)

    @cached_property
    def alt_prices(self) -> DataFrame:
        return stg_prices(td.raw_alternative_prices(self.spark, self.sf), td.version_order())

    @cached_property
    def raw_population_history(self) -> DataFrame:
        """Landed once: both population tables derive from it."""
        return materialize(td.raw_population_history(self.spark, self.sf))

    @cached_property
    def population(self) -> DataFrame:
        return stg_population(td.raw_population(self.spark, self.sf, self.raw_population_history))

    @cached_property
    def income(self) -> DataFrame:
        return stg_income(td.raw_income(self.spark, self.sf))

    @cached_property
    def population_history(self) -> DataFrame:
        return stg_population_history(self.raw_population_history)

    @cached_property
    def tax(self) -> DataFrame:
        return stg_property_tax(td.raw_property_tax(self.spark, self.sf))

    @cached_property
    def departments(self) -> DataFrame:
        return td.departments(self.spark, self.sf)

    @cached_property
    def equity_watchlist(self) -> DataFrame:
        return td.equity_watchlist(self.spark, self.sf)

    @cached_property
    def alt_watchlist(self) -> DataFrame:
        return td.alternatives_watchlist(self.spark, self.sf)

    # ---- intermediate ----------------------------------------------------
    @cached_property
    def period_stats(self) -> DataFrame:
        return places.period_stats(self.sales, self.p)

    @cached_property
    def stats(self) -> DataFrame:
        """period_stats, checkpointed: read by the CAGR and the score."""
        return materialize(self.period_stats)

    @cached_property
    def price_cagr(self) -> DataFrame:
        return places.price_cagr(self.stats, self.p)

    @cached_property
    def indicators(self) -> DataFrame:
        return places.commune_indicators(self.population, self.income)

    @cached_property
    def population_cagr(self) -> DataFrame:
        return places.population_cagr(self.population_history)

    @cached_property
    def latest_tax(self) -> DataFrame:
        return places.latest_tax(self.tax)

    # ---- marts -----------------------------------------------------------
    def commune_score(self, rounded: bool = True) -> DataFrame:
        return places.commune_opportunity_score(
            self.stats, self.indicators, self.price_cagr, self.population_cagr, self.latest_tax,
            self.departments, self.p, rounded=rounded,
        )

    # A mart is written as a table where a consumer reads it more than once
    # (rollup medians, serving queries that attach national figures); a
    # single-use consumer reads the lazy plan.
    @cached_property
    def score(self) -> DataFrame:
        """The commune mart as a lazy plan (single-use consumers)."""
        return self.commune_score()

    @cached_property
    def score_table(self) -> DataFrame:
        """The commune mart written once (read several times downstream)."""
        return materialize(self.score)

    @cached_property
    def dept_score(self) -> DataFrame:
        return materialize(places.department_opportunity_score(self.score_table, self.p, score_is_table=True))

    @cached_property
    def equity_summary(self) -> DataFrame:
        return series.equity_performance_summary(self.equity_prices, self.equity_watchlist, self.p)

    @cached_property
    def alt_summary(self) -> DataFrame:
        return series.alternatives_performance_summary(self.alt_prices, self.alt_watchlist, self.p)
