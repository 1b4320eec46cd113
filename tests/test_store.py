import gzip
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from cadastra.operators.ordinal import by_metric, with_ordinal
from cadastra.plans import landed
from cadastra.sources import document, files, landing
from cadastra.sources.store import RawStore, land_sales

DAY1, DAY2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def _put(root, year, dep, data):
    d = root / str(year)
    d.mkdir(parents=True, exist_ok=True)
    (d / f"{dep}.csv.gz").write_bytes(data)


def _csv(header, *rows):
    return gzip.compress(("\n".join([header, *rows]) + "\n").encode())


def _report(df):
    return {(r["code_departement"], r["year"]): (r["status"], r["rows_landed"]) for r in df.collect()}


def _expected(spark, *pairs):
    return spark.createDataFrame(list(pairs), "code_departement string, year int")


def test_one_damaged_file_does_not_end_the_load(spark, tmp_path):
    root = tmp_path / "in"
    _put(root, 2022, "01", _csv("Id Mutation,Valeur Foncière", "a,1", "b,2"))
    _put(root, 2022, "02", landed.cut_short())
    _put(root, 2023, "01", _csv("valeur fonciere,id mutation,Note", "3,c,x"))  # another order, one more column
    _put(root, 2023, "02", _csv("Id Mutation,Valeur Foncière"))
    _put(root, 2023, "2A", b"")
    store = RawStore(spark, str(tmp_path / "store"))
    want = _expected(spark, ("01", 2022), ("02", 2022), ("01", 2023), ("02", 2023), ("2A", 2023), ("2B", 2023))
    for _ in range(2):  # landing a load again replaces it
        report = _report(land_sales(store, str(root), want, "l1", DAY1))
        assert report == {("01", 2022): ("landed", 2), ("02", 2022): ("damaged", 0), ("01", 2023): ("landed", 1),
                          ("02", 2023): ("empty", 0), ("2A", 2023): ("empty", 0), ("2B", 2023): ("missing", 0)}
    rows = store.read("transactions").select("id_mutation", "valeur_fonciere", "source_departement", "source_year").collect()
    assert sorted(map(tuple, rows)) == [("a", "1", "01", 2022), ("b", "2", "01", 2022), ("c", "3", "01", 2023)]
    assert "note" in store.read("transactions", every_column=True).columns
    assert "note" not in store.read("transactions").columns

    _put(root, 2022, "02", _csv("id_mutation,valeur_fonciere", "d,4"))
    assert _report(land_sales(store, str(root), want, "l2", DAY2))[("02", 2022)] == ("landed", 1)
    assert store.read("transactions").groupBy("load_id").count().count() == 2


def test_only_damaged_files_are_an_error(spark, tmp_path):
    root = tmp_path / "in"
    _put(root, 2022, "01", landed.cut_short())
    _put(root, 2022, "02", b"\x1f\x8bno gzip at all")
    with pytest.raises(RuntimeError, match="all 2 expected"):
        land_sales(RawStore(spark, str(tmp_path / "s")), str(root), _expected(spark, ("01", 2022), ("02", 2022)), "l", DAY1)


def test_nothing_delivered(spark, tmp_path):
    store = RawStore(spark, str(tmp_path / "s"))
    assert _report(land_sales(store, str(tmp_path / "none"), _expected(spark, ("01", 2022)), "l", DAY1)) == {("01", 2022): ("missing", 0)}
    assert store.read("transactions").count() == 0 and store.read("commune_income").count() == 0


def test_first_lines_read_one_buffer(spark, tmp_path):
    big = tmp_path / "big.csv"
    big.write_bytes(b"a,b\r\n" + b"1,2\n" * 2_000_000)
    (tmp_path / "small.csv.gz").write_bytes(gzip.compress("é,b".encode()))
    (tmp_path / "empty.csv").write_bytes(b"")
    found = files.first_lines(spark, files.list_files(spark, str(tmp_path)))
    assert sorted(found.values()) == [b"a,b", "é,b".encode()]


def test_reference_tables_replace_delivered_partitions_only(spark, tmp_path):
    store = RawStore(spark, str(tmp_path))
    tax = "insee_com string, libcom string, exercice string, taux_global_tfb string"
    store.write("commune_property_tax", spark.createDataFrame([("1", "x", "2000", "1"), ("1", "x", "2001", "2")], tax), DAY1)
    store.write("commune_property_tax", spark.createDataFrame([("1", "x", "2001", "3"), ("02", "y", "2001", "4")], tax), DAY2)
    got = sorted((r["insee_com"], r["exercice"], r["taux_global_tfb"]) for r in store.read("commune_property_tax").collect())
    assert got == [("02", "2001", "4"), ("1", "2000", "1"), ("1", "2001", "3")]
    income = "code_geographique string, libelle_geographique string, disp_mediane double"
    for n in (3, 2):
        assert store.write("commune_income", spark.createDataFrame([(str(i), "z", 1.5) for i in range(n)], income), DAY1) == n
    assert store.read("commune_income").count() == 2
    assert dict(store.read("commune_income").dtypes)["disp_mediane"] == "string"
    with pytest.raises(ValueError):
        store.write("transactions", spark.range(1), DAY1)


def test_encoding_is_told_file_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Libellé;n\nÉté Ã©;1\nplain;2\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("libelle,n\nété,3\n".encode())
    (tmp_path / "c.csv").write_bytes("n;Libellé\n4;ascii\n5;\n".encode("latin-1"))
    got = sorted((r["n"], r["libelle"]) for r in landing.read_delimited(spark, str(tmp_path)).collect())
    assert got == [("1", "Été Ã©"), ("2", "plain"), ("3", "été"), ("4", "ascii"), ("5", None)]


def test_ordinals_are_gapless_with_missing_last(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 11).alias("m")).repartition(9)
    got = with_ordinal(df, by_metric("m", "id")).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(1, 501))
    assert [r["id"] for r in got] == sorted(range(500), key=lambda i: (i % 7 == 0, -(i % 11) if i % 7 else 0, i))
    assert with_ordinal(df.limit(0), by_metric("m", "id")).count() == 0


def test_document_parts_join_to_json(spark, tmp_path):
    equity = spark.createDataFrame(
        [(f"T{i:03d}", 'quote " and \\', "etf" if i % 2 else "stock", 100, None if i % 3 == 0 else 0.1, 0.2, i % 5 != 0) for i in range(200)],
        "ticker string, name string, asset_type string, trading_days long, annualized_return double, annualized_volatility double, pea_eligible boolean")
    alts = spark.createDataFrame([], "ticker string, name string, asset_class string, instrument_type string, liquidity string,"
                                     " trading_days long, annualized_return double, annualized_volatility double")
    depts = spark.createDataFrame([("01", "Ain", None), ("02", None, 0.03)], "code_departement string, nom_departement string, median_price_cagr double")
    lines = document.lines(equity, alts, depts, datetime(2024, 2, 1, tzinfo=timezone.utc))
    document.write(lines, str(tmp_path / "doc"))
    whole = "\n".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*")))
    doc = json.loads(whole)
    assert [r["ticker"] for r in doc["equities"]["pea_eligible"]] == [f"T{i:03d}" for i in range(200) if i % 5]
    assert doc["equities"]["pea_eligible"][2]["annualized_return"] is None and doc["alternatives"]["watchlist"] == []
    assert doc["real_estate"]["by_department"] == [{"code_departement": "02", "nom_departement": None, "median_price_cagr": 0.03}]
    assert doc["exported_at"] == "2024-02-01T00:00:00+00:00" and doc["alternatives"]["blended_default"]["annualized_return"] == 0.06
    assert json.loads(document.text(lines).first()[0]) == doc
    with pytest.raises(ValueError):
        document.text(lines, max_lines=10)


def test_long_document_is_read_back_line_by_line(spark, tmp_path):
    n = 100_001  # more lines than the bound of document.text
    equity = spark.range(n).select(
        F.format_string("T%06d", "id").alias("ticker"), F.lit('], "x": [{"').alias("name"), F.lit("etf").alias("asset_type"),
        F.lit(100).cast("long").alias("trading_days"), F.lit(0.1).alias("annualized_return"), F.lit(0.2).alias("annualized_volatility"),
        F.lit(True).alias("pea_eligible"))
    alts = spark.createDataFrame([], "ticker string, name string, asset_class string, instrument_type string, liquidity string,"
                                     " trading_days long, annualized_return double, annualized_volatility double")
    depts = spark.createDataFrame([("01", "Ain", None), (None, "line\nfeed", 0.03)], "code_departement string, nom_departement string, median_price_cagr double")
    document.write(document.lines(equity, alts, depts, datetime(2024, 2, 1, tzinfo=timezone.utc)), str(tmp_path / "doc"))
    doc = document.read(spark, str(tmp_path / "doc"))
    listed = document.rows(doc, 1)
    assert listed.count() == n
    assert listed.where(F.col("x.ticker") != F.format_string("T%06d", "place")).count() == 0
    assert document.rows(doc, 3).count() == 0
    assert [(r["place"], r["x"]["nom_departement"]) for r in document.rows(doc, 5).collect()] == [(0, "line\nfeed")]
    head = document.header(doc).collect()
    assert len(head) == 1 and head[0]["exported_at"] == "2024-02-01T00:00:00+00:00" and head[0]["equities"]["pea_eligible"] == []


def test_export_document_has_no_bound(spark, monkeypatch):
    from cadastra.plans import registry

    monkeypatch.setattr(document.text, "__defaults__", (10,))  # lines one value may hold
    assert registry.QUERIES["export_document"](spark, "/root/testdata/sf0.001").count() > 10
