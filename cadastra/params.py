"""The whole tunable surface, as one frozen dataclass.

Fixed values below are the defaults the marts must reproduce; they are
parameters so tests can move a gate (e.g. a thin-year run at 20 sales).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # --- fixed values (defaults of the reference project) -----------------
    min_reliable_transaction_count: int = 5
    max_price_cagr_pct: float = 0.15
    high_liquidity_transactions_per_capita: float = 0.02
    max_population_cagr_pct: float = 0.05
    min_commune_population: int = 2000
    min_annual_transaction_count: int = 15
    high_property_tax_threshold_pct: float = 35.0  # percentage points
    max_property_tax_penalty_pts: float = 15.0
    min_trading_days_for_return: int = 60
    risk_free_rate_pct: float = 0.025  # a fraction despite the name
    benchmark_ticker: str = "CW8.PA"

    # literals of the models, promoted to parameters
    property_types: tuple[str, ...] = ("Maison", "Appartement")
    excluded_sale_kinds: tuple[str, ...] = ("Adjudication", "Echange", "Expropriation")
    min_price_per_sqm: float = 100.0
    max_price_per_sqm: float = 30000.0
    min_cagr_span_years: int = 2
    volatility_window_rows: int = 30
    end_price_rows: int = 5
    trading_days_per_year: float = 252.0
    income_cap: float = 30000.0
    # score weights: 20/20/20/15/15 out of the 90 scored points, rescaled to 100
    weight_price: float = 20.0
    weight_price_growth: float = 20.0
    weight_liquidity: float = 20.0
    weight_population_growth: float = 15.0
    weight_income: float = 15.0
    weight_total: float = 90.0

    # fallbacks of the assumptions export (used only when no row qualifies)
    equities_fallback_return: float = 0.07
    equities_fallback_volatility: float = 0.15
    alternatives_fallback_return: float = 0.06
    alternatives_fallback_volatility: float = 0.35
    real_estate_fallback_cagr: float = 0.03
    # guard rails applied to the live blends before they are used
    blended_return_limit: float = 0.20
    real_estate_cagr_limit: float = 0.15

    # exact median: groups larger than this take the sketch-bracket path.
    # percentile_disc keeps up to 128 groups' buffers per task before it
    # falls back to sort-based aggregation, so 128 x this bounds the distinct
    # values one task holds. The sketch's relative rank error is 1/accuracy.
    median_max_exact_group: int = 100_000
    median_sketch_accuracy: int = 1000

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
