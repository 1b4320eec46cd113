"""Edge semantics that are easy to get wrong and small readers."""

from datetime import datetime

from pyspark.sql import functions as F

from cadastra.operators import serving
from cadastra.operators.dedupe import latest_wins
from cadastra.sources import landing, seeds


def test_integer_cast_of_decimal_text_is_null(spark):
    df = spark.createDataFrame([("3",), ("3.5",), ("x",)], "n string")
    got = [r[0] for r in df.select(F.col("n").try_cast("bigint")).collect()]
    assert got == [3, None, None]


def test_equal_ingest_time_needs_a_tiebreak(spark):
    t = datetime(2024, 1, 1)
    rows = [("k", t, 1), ("k", t, 3), ("k", t, 2)]
    df = spark.createDataFrame(rows, "key string, _ingested_at timestamp, v int")
    order = [F.col("_ingested_at").desc(), F.col("v").desc()]
    for _ in range(3):
        assert latest_wins(df.repartition(3), ["key"], order).first()["v"] == 3


def test_running_max_needs_rows_frame(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 7.0), ("a", 2, 6.0)], "t string, d int, p double")
    w = Window.partitionBy("t").orderBy("d", "p")
    rows_frame = df.select(F.max("p").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m")).collect()
    assert sorted(r["m"] for r in rows_frame) == [5.0, 7.0, 7.0]


def test_seed_codes_stay_strings(spark, tmp_path):
    p = tmp_path / "departements.csv"
    p.write_text("code_departement,nom_departement\n01,Ain\n2A,Corse-du-Sud\n", encoding="utf-8")
    df = seeds.read_seed(spark, str(p), seeds.DEPARTMENTS)
    assert [r[0] for r in df.orderBy("code_departement").collect()] == ["01", "2A"]
    wl = tmp_path / "watch.csv"
    wl.write_text("ticker,name,asset_type,sector,pea_eligible,isin\nCW8.PA,World,etf,Index,true,FR0011\n"
                  ",blank,stock,x,false,FR1\n", encoding="utf-8")
    w = seeds.read_seed(spark, str(wl), seeds.EQUITY_WATCHLIST)
    assert w.where("pea_eligible").count() == 1
    assert [r[0] for r in seeds.tickers(w).collect()] == ["CW8.PA"]


def test_parquet_reference_reader_normalises_headers(spark, tmp_path):
    p = str(tmp_path / "hist.parquet")
    spark.createDataFrame([("01001", 2021, 800)], "CODGEO string, `Année RP` int, PMUN long").write.parquet(p)
    assert landing.read_parquet(spark, p).columns == ["codgeo", "annee_rp", "pmun"]


def test_alternatives_kpis_instrument_filter(spark):
    df = spark.createDataFrame(
        [("A", "spot", "liquid", 0.1, 0.2, 0.5), ("B", "spot", "illiquid", 0.3, None, 0.1),
         ("C", "etf", "liquid", None, 0.4, -0.2)],
        "ticker string, instrument_type string, liquidity string, annualized_return double, "
        "annualized_volatility double, period_return_pct double")
    k = serving.alternatives_kpis(df, instrument="spot").first()
    assert k["ticker_count"] == 2 and k["liquid_count"] == 1
    assert k["best_return_ticker"] == "B"
    assert abs(k["avg_return"] - 0.2) < 1e-12


def test_min_max_scale_flat_and_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", None)], "k string, v double")
    got = {r["k"]: r["scaled"] for r in serving.min_max_scale(df, "v").collect()}
    assert got == {"a": 0.5, "b": 0.5, "c": None}


def test_top_n_keeps_missing_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("c", 3.0), ("d", 2.0)], "k string, s double")
    assert [r["k"] for r in serving.top_n(df, "s", 3, "k").collect()] == ["c", "b", "d"]
