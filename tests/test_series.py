import math
from datetime import date, timedelta

from pyspark.sql import functions as F

from cadastra.operators import series
from cadastra.params import Params

P = Params(benchmark_ticker="BENCH")


def prices(spark, spec):
    """spec: ticker -> list of prices on consecutive days from 2024-01-01."""
    rows = []
    for t, ps in spec.items():
        for i, p in enumerate(ps):
            rows.append((t, date(2024, 1, 1) + timedelta(days=i), p, 0.1 if t == "DIV" else None))
    return spark.createDataFrame(rows, "ticker string, date date, adj_close double, dividends double")


def watch(spark):
    return spark.createDataFrame(
        [("BENCH", "b", "etf", "s", True, "FR0001"), ("A", "a", "stock", "s", True, "NL0002")],
        "ticker string, name string, asset_type string, sector string, pea_eligible boolean, isin string")


def test_returns_volatility_drawdown(spark):
    df = series.daily_returns(prices(spark, {"A": [10.0, 11.0, 9.9, 12.0]}), P).orderBy("date").collect()
    assert df[0]["daily_return"] is None and df[0]["rolling_30d_volatility"] is None
    assert math.isclose(df[1]["daily_return"], 0.1)
    assert df[1]["rolling_30d_volatility"] is None  # one non-null return: sample stddev undefined
    assert math.isclose(df[2]["drawdown_pct"], 9.9 / 11 - 1)
    assert df[3]["drawdown_pct"] == 0.0
    assert all(r["drawdown_pct"] <= 0 for r in df)


def test_gate_at_min_trading_days(spark):
    spec = {"T1": [1.0], "T4": [1.0, 2.0, 3.0, 4.0], "T59": [1.0 + i / 100 for i in range(59)],
            "T60": [1.0 + i / 100 for i in range(60)]}
    wl = spark.createDataFrame([], "ticker string, name string, asset_class string, instrument_type string, "
                                   "liquidity string")
    out = {r["ticker"]: r for r in series.alternatives_performance_summary(prices(spark, spec), wl, P).collect()}
    for t in ("T1", "T4", "T59"):
        assert out[t]["annualized_return"] is None and out[t]["max_drawdown_pct"] is None
        assert out[t]["sharpe_ratio"] is None
    # under 5 bars both windows cover every bar: medians 2.0 and 2.0; not gated, a value
    assert out["T4"]["first_price"] == 2.0 and out["T4"]["period_return_pct"] == 0.0
    assert out["T60"]["trading_days"] == 60 and out["T60"]["annualized_return"] is not None
    assert out["T1"]["avg_daily_return"] is None


def test_end_price_median_resists_one_glitch(spark):
    ps = [10.0] * 30 + [1000.0] + [10.0] * 4
    out = series.end_prices(series.daily_returns(prices(spark, {"G": ps}), P), P).first()
    assert out["first_price"] == 10.0 and out["last_price"] == 10.0


def test_benchmark_relative_and_empty_benchmark(spark):
    spec = {"BENCH": [100.0 * 1.001 ** i for i in range(80)], "A": [50.0 * 1.002 ** i for i in range(90)]}
    out = {r["ticker"]: r for r in series.equity_performance_summary(prices(spark, spec), watch(spark), P).collect()}
    assert out["BENCH"]["relative_performance_vs_benchmark"] == 0.0
    assert out["A"]["relative_performance_vs_benchmark"] > 0
    assert out["A"]["country"] == "NL"
    missing = Params(benchmark_ticker="NOPE")
    out2 = series.equity_performance_summary(prices(spark, spec), watch(spark), missing).collect()
    assert len(out2) == 2 and all(r["relative_performance_vs_benchmark"] is None for r in out2)


def test_short_benchmark_gives_null_relative(spark):
    spec = {"BENCH": [1.0 + i / 100 for i in range(30)], "A": [1.0 + i / 100 for i in range(90)]}
    out = series.equity_performance_summary(prices(spark, spec), watch(spark), P).collect()
    assert all(r["relative_performance_vs_benchmark"] is None for r in out)


def test_returns_invariant_to_price_scale(spark):
    base = [10.0, 10.5, 10.2, 11.0, 10.9, 11.3]
    a = series.daily_returns(prices(spark, {"X": base}), P).orderBy("date").collect()
    b = series.daily_returns(prices(spark, {"X": [p * 7 for p in base]}), P).orderBy("date").collect()
    for r, s in zip(a, b):
        assert (r["daily_return"] is None) == (s["daily_return"] is None)
        if r["daily_return"] is not None:
            assert math.isclose(r["daily_return"], s["daily_return"], rel_tol=1e-12)


def test_dividends_sum_and_yield(spark):
    spec = {"DIV": [10.0] * 10}
    wl = watch(spark)
    r = series.equity_performance_summary(prices(spark, spec), wl, P).first()
    assert math.isclose(r["total_dividends"], 1.0)
    assert math.isclose(r["dividend_yield_pct"], 0.1)
    assert r["name"] is None  # not on the watchlist: left join keeps it
    _ = F


def test_aligned_returns_use_only_the_benchmark_window(spark):
    # A starts 10 days before the benchmark: its aligned figure uses only the overlapping bars
    spec = {"BENCH": [1.0] * 10 + [100.0 * 1.001 ** i for i in range(70)],
            "A": [5.0] * 10 + [50.0 * 1.002 ** i for i in range(80)]}
    rows = []
    for t, ps in spec.items():
        start = 0 if t == "A" else 10
        for i, p in enumerate(ps[start:] if t == "BENCH" else ps):
            rows.append((t, date(2024, 1, 1) + timedelta(days=(i + start) if t == "BENCH" else i), p, None))
    df = spark.createDataFrame(rows, "ticker string, date date, adj_close double, dividends double")
    r = series.daily_returns(df, P)
    win = series.benchmark_window(r, P).first()
    assert str(win["_b_first"]) == "2024-01-11"
    out = {x["ticker"]: x["aligned_annualized_return"] for x in series.aligned_returns(r, P).collect()}
    # inside the window A's bars are a clean 0.2%/day series: the 5.0 prefix is excluded
    n_in = 70
    first = 50.0 * 1.002 ** 2   # lower median of the first five in-window bars (rows 10..14 of A)
    last = 50.0 * 1.002 ** 67   # lower median of the last five in-window bars (days 75-79)
    assert math.isclose(out["A"], (last / first) ** (252.0 / n_in) - 1, rel_tol=1e-9)


def test_end_prices_for_any_number_of_rows(spark):
    def lower(vs):
        vs = sorted(v for v in vs if v is not None)
        return vs[(len(vs) + 1) // 2 - 1] if vs else None

    spec = {"L": [float(i * 7 % 11) for i in range(30)], "S": [3.0, 1.0], "N": [None, 4.0, None, 2.0, None, None, None, 6.0], "Z": [None] * 4}
    bars = prices(spark, spec).drop("dividends")
    for k in (1, 2, 5, 20):
        got = {r["ticker"]: (r["first_price"], r["last_price"]) for r in series.end_prices(bars, Params(end_price_rows=k)).collect()}
        assert got == {t: (lower(ps[:k]), lower(ps[-k:])) for t, ps in spec.items()}


def test_summary_runs_one_window_pass_and_no_object_aggregate(spark):
    bars = prices(spark, {"BENCH": [100.0] * 3, "A": [1.0, 2.0]})
    r = series._returns(series._mark_inside(bars, series.benchmark_window(bars, P)), P, carry=("dividends", "_in"))
    plan = series._per_ticker(r, P, with_dividends=True, aligned=True)._jdf.queryExecution().executedPlan().toString()
    passes = [line for line in plan.splitlines() if "Window [" in line and "windowspecdefinition(ticker" in line]
    assert len(passes) == 1 and "ObjectHashAggregate" not in plan
