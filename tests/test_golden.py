"""Golden relations from the published outputs (values copied as fixed data)."""

import math

from pyspark.sql import functions as F

from cadastra.operators import assumptions
from cadastra.params import Params

# The four published alternatives rows
# (ticker, liquidity, first_price, last_price, trading_days, period_return_pct,
#  annualized_return, annualized_volatility, sharpe_ratio)
ALTERNATIVES = [
    ("GC=F", "illiquid", 1750.4000244140625, 4245.7998046875, 1257, 1.4256168564147271,
     0.19439541184301445, 0.18716420946651463, 0.9050630584012422),
    ("GLD", "liquid", 164.0, 389.6400146484375, 1255, 1.3758537478563262,
     0.18977105338676736, 0.185558397681992, 0.8879741118973782),
    ("BTC-USD", "liquid", 45593.63671875, 64880.19140625, 1827, 0.42300978986325444,
     0.04986177241247303, 0.43308886488887377, 0.05740570683767708),
    ("ETH-USD", "liquid", 3164.2451171875, 1913.010009765625, 1827, -0.39542926071859436,
     -0.06705771914786451, 0.5798475160513449, -0.15876194447595582),
]
# The published blends of those rows
ALT_BLEND = (0.09174262962359758, 0.34641474702218134)
LIQUID_BLEND = (0.057525035550458625, 0.399498259540737)


def frame(spark):
    return spark.createDataFrame(ALTERNATIVES, "ticker string, liquidity string, first_price double, "
                                 "last_price double, trading_days long, period_return_pct double, "
                                 "annualized_return double, annualized_volatility double, sharpe_ratio double")


def test_return_relations(spark):
    from cadastra.functions import safe_div, safe_pow

    df = frame(spark).select(
        "ticker", "period_return_pct", "annualized_return", "sharpe_ratio",
        safe_div(F.col("last_price") - F.col("first_price"), F.col("first_price")).alias("k08"),
        (safe_pow(safe_div(F.col("last_price"), F.col("first_price")), F.lit(252.0) / F.col("trading_days"))
         - 1).alias("a10"),
        safe_div(F.col("annualized_return") - F.lit(0.025), F.col("annualized_volatility")).alias("k10"),
    )
    for r in df.collect():
        assert math.isclose(r["k08"], r["period_return_pct"], abs_tol=3e-16)
        assert math.isclose(r["a10"], r["annualized_return"], abs_tol=1e-15)
        assert math.isclose(r["k10"], r["sharpe_ratio"], abs_tol=1e-15)


def test_blends(spark):
    b = assumptions.alternatives_blends(frame(spark), Params()).first()
    assert math.isclose(b["alternatives_annualized_return"], ALT_BLEND[0], abs_tol=3e-16)
    assert math.isclose(b["alternatives_annualized_volatility"], ALT_BLEND[1], abs_tol=3e-16)
    assert math.isclose(b["liquid_annualized_return"], LIQUID_BLEND[0], abs_tol=3e-16)
    assert math.isclose(b["liquid_annualized_volatility"], LIQUID_BLEND[1], abs_tol=3e-16)
    assert b["liquid_count"] == 3
    assert b["liquid_method"].startswith("equal-weighted mean across 3 liquid alternatives tickers")


def test_blend_fallback_when_nothing_qualifies(spark):
    empty = frame(spark).withColumn("annualized_return", F.lit(None).cast("double"))
    b = assumptions.alternatives_blends(empty, Params()).first()
    assert b["alternatives_annualized_return"] == 0.06
    assert b["alternatives_annualized_volatility"] == 0.35
    assert b["alternatives_count"] == 0
    assert b["alternatives_method"].startswith("fallback illustrative assumption")


def test_national_median_is_lower_discrete(spark):
    # 92 sorted department values: the lower median is the 46th, not the average of 46th/47th
    vals = [i / 1000.0 for i in range(92)]
    df = spark.createDataFrame([(f"d{i}", v) for i, v in enumerate(vals)], "code_departement string, "
                               "median_price_cagr double")
    row = assumptions.national_median_cagr(df, Params()).first()
    assert row["national_median_price_cagr"] == vals[45]
    assert row["national_median_price_cagr_is_fallback"] is False
    none = assumptions.national_median_cagr(df.where("false"), Params()).first()
    assert none["national_median_price_cagr"] == 0.03 and none["national_median_price_cagr_is_fallback"]
