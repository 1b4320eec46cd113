import gzip
import os
from datetime import datetime

from pyspark.sql import functions as F

from cadastra.sources import landing


def test_sales_csv_lineage_and_header_names(spark, tmp_path):
    root = tmp_path / "dvf"
    for year, dep, rows in [(2022, "01", ["1,100"]), (2023, "2A", ["2,200", "3,300"]), (2023, "02", [])]:
        d = root / str(year)
        d.mkdir(parents=True, exist_ok=True)
        with gzip.open(d / f"{dep}.csv.gz", "wt", encoding="utf-8") as f:
            f.write("Id Mutation,Valeur Foncière\n" + "".join(r + "\n" for r in rows))
    df = landing.read_sales_csv(spark, str(root))
    got = sorted((r["id_mutation"], r["valeur_fonciere"], r["source_departement"], r["source_year"])
                 for r in df.collect())
    assert got == [("1", "100", "01", 2022), ("2", "200", "2A", 2023), ("3", "300", "2A", 2023)]


def test_delimiter_and_encoding_fallback(spark, tmp_path):
    semi = tmp_path / "semi.csv"
    semi.write_bytes("CODGEO;Libellé;P21_POP\n01001;Abergement-Clémenciat;800\n".encode("latin-1"))
    df = landing.read_delimited(spark, str(semi))
    assert df.columns == ["codgeo", "libelle", "p21_pop"]
    assert df.first()["libelle"] == "Abergement-Clémenciat"
    comma = tmp_path / "comma.csv"
    comma.write_text("a,b\n1,2\n", encoding="utf-8")
    assert landing.detect_delimiter(spark, str(comma)) == ","
    single = tmp_path / "single.csv"
    single.write_text("onlyone\n1\n", encoding="utf-8")
    import pytest

    with pytest.raises(ValueError):
        landing.detect_delimiter(spark, str(single))


def test_wide_to_long_drops_placeholders(spark):
    wide = spark.createDataFrame(
        [("2024-01-06", 1.0, 2.0, None, float("nan")), ("2024-01-05", 1.5, 2.5, 3.0, 4.0)],
        "date string, `Close|BTC` double, `Adj Close|BTC` double, `Close|GLD` double, `Adj Close|GLD` double")
    out = landing.wide_to_long(wide, "date", ["Close", "Adj Close"], ["BTC", "GLD"])
    got = sorted((r["ticker"], r["date"], r["Close"], r["Adj Close"]) for r in out.collect())
    assert got == [("BTC", "2024-01-05", 1.5, 2.5), ("BTC", "2024-01-06", 1.0, 2.0), ("GLD", "2024-01-05", 3.0, 4.0)]


def test_union_stamp_and_counted_writes(spark, tmp_path):
    a = spark.createDataFrame([("X", 1.0)], "ticker string, close double")
    b = spark.createDataFrame([("Y", 2.0, 5)], "ticker string, close double, volume int")
    u = landing.union_frames([a, b])
    assert u.count() == 2 and "volume" in u.columns
    s = landing.stamp(u, datetime(2024, 1, 1))
    path = str(tmp_path / "raw")
    assert landing.append(s, path) == 2
    assert landing.append(s, path) == 2
    assert spark.read.parquet(path).count() == 4
    assert landing.replace(s.where(F.col("ticker") == "X"), path) == 1
    assert spark.read.parquet(path).count() == 1
    assert os.path.isdir(path)


def test_deliveries_are_ranked_once_and_whole(spark):
    from cadastra.plans import landed
    from cadastra.sources import testdata as td

    sf = "/root/testdata/sf0.001"
    older, newest = landed._versions(spark, sf)
    assert not any("lineitem" in f for df in (older, newest) for f in df.inputFiles())  # both read the written ranks
    raw = td.raw_transactions(spark, sf)
    assert older.unionByName(newest).exceptAll(raw).count() == 0 and raw.exceptAll(older.unionByName(newest)).count() == 0
    key = ["id_mutation", "id_parcelle", "numero_disposition"]
    assert newest.count() == newest.select(*key).distinct().count() == raw.select(*key).distinct().count()
