import math

from pyspark.sql import functions as F

from cadastra.operators import places
from cadastra.params import Params

P = Params()
STG = ("code_commune string, nom_commune string, code_departement string, type_local string, "
       "nature_mutation string, valeur_fonciere double, surface_reelle_bati double, source_year int")


def staged(spark, rows):
    return spark.createDataFrame(rows, STG)


def sales(commune, year, prices, typ="Maison", kind="Vente", dep="01", surface=1.0):
    return [(commune, "N" + commune, dep, typ, kind, float(p), surface, year) for p in prices]


def by_key(df, *cols):
    return {tuple(r[c] for c in cols): r for r in df.collect()}


def test_filters_band_kinds_and_types(spark):
    rows = (sales("c", 2022, [100, 30000, 99.99, 30000.01])
            + sales("c", 2022, [500], kind="Adjudication")
            + sales("c", 2022, [500], kind=None)             # null kind drops out (3-valued NOT IN)
            + sales("c", 2022, [500], typ="Dependance")
            + [("c", "Nc", "01", "Maison", "Vente", None, 1.0, 2022)])
    q = places.qualifying_sales(staged(spark, rows), P)
    assert sorted(r["price_per_sqm"] for r in q.collect()) == [100.0, 30000.0]


def test_yoy_needs_reliable_previous_year_and_no_gap(spark):
    rows = (sales("a", 2021, [1000] * 5) + sales("a", 2022, [1100] * 3)   # thin 2022
            + sales("a", 2023, [1210] * 6)                                # prev thin -> null yoy
            + sales("b", 2021, [1000] * 5) + sales("b", 2023, [2000] * 5)  # gap: no prev row
            + sales("d", 2021, [1000] * 5) + sales("d", 2022, [1500] * 1))
    ps = by_key(places.period_stats(staged(spark, rows), P), "code_commune", "year")
    assert ps[("a", 2022)]["yoy_price_change_pct"] == 0.1
    assert ps[("a", 2023)]["prior_year_median_price_per_sqm"] == 1100.0
    assert ps[("a", 2023)]["yoy_price_change_pct"] is None
    assert ps[("b", 2023)]["prior_year_median_price_per_sqm"] is None
    assert ps[("d", 2022)]["yoy_price_change_pct"] == 0.5
    assert ps[("a", 2021)]["transaction_count"] == 5


def test_even_group_takes_lower_median(spark):
    ps = places.period_stats(staged(spark, sales("e", 2022, [400, 100, 300, 200])), P).first()
    assert ps["median_price_per_sqm"] == 200.0


def test_commune_under_two_departments_fans_out(spark):
    rows = sales("f", 2021, [1000] * 5, dep="01") + sales("f", 2021, [1200] * 5, dep="02") + sales(
        "f", 2022, [1100] * 5, dep="01")
    ps = places.period_stats(staged(spark, rows), P).where("year = 2022").collect()
    assert sorted(r["prior_year_median_price_per_sqm"] for r in ps) == [1000.0, 1200.0]


def test_price_cagr_span(spark):
    stats = spark.createDataFrame(
        [("a", "Maison", 2021, 5, 1000.0), ("a", "Maison", 2022, 5, 5000.0),      # span 1: none
         ("b", "Maison", 2021, 5, 1000.0), ("b", "Maison", 2023, 5, 1210.0),      # span 2
         ("b", "Maison", 2024, 4, 9999.0),                                       # unreliable endpoint
         ("z", "Maison", 2020, 5, 0.0), ("z", "Maison", 2023, 5, 10.0)],          # zero first price
        "code_commune string, type_local string, year int, transaction_count long, median_price_per_sqm double")
    out = by_key(places.price_cagr(stats, P), "code_commune")
    assert set(out) == {("b",), ("z",)}
    assert math.isclose(out[("b",)]["price_cagr"], 0.1, rel_tol=1e-12)
    assert out[("b",)]["year_span"] == 2
    assert out[("z",)]["price_cagr"] is None


def test_population_cagr_positive_rows_only(spark):
    hist = spark.createDataFrame(
        [("a", "A", "01", 2017, 1000), ("a", "A", "01", 2021, 1100), ("a", "A", "01", 2016, 0),
         ("b", "B", "01", 2018, 500)],
        "code_insee string, nom_commune string, code_departement string, year long, population long")
    out = by_key(places.population_cagr(hist), "code_insee")
    assert set(out) == {("a",)}
    assert out[("a",)]["first_year"] == 2017
    assert math.isclose(out[("a",)]["population_cagr"], 1.1 ** 0.25 - 1, rel_tol=1e-12)


def test_tax_penalty_ramp(spark):
    rates = [None, 35.0, 52.5, 70.0, 73.1, 10.0]
    df = spark.createDataFrame([(r,) for r in rates], "t double")
    got = [r["p"] for r in df.select(F.round(places.tax_penalty(F.col("t"), P), 1).alias("p")).collect()]
    assert got == [0.0, 0.0, 7.5, 15.0, 15.0, 0.0]


def test_score_bounds_and_neutral_missing_factors(spark):
    stats = spark.createDataFrame(
        [(c, "N" + c, "01", t, 2023, 20, float(p), None)
         for c, p in [("a", 1000), ("b", 3000), ("c", 500), ("d", 800), ("e", 900)] for t in ["Maison"]],
        "code_commune string, nom_commune string, code_departement string, type_local string, year int, "
        "transaction_count long, median_price_per_sqm double, yoy_price_change_pct double")
    ind = spark.createDataFrame(
        [("a", "01", "84", 5000, 10.0, 500.0, 25000.0), ("b", "01", "84", 100000, 10.0, 1.0, None),
         ("c", "01", "84", 1500, 1.0, 1.0, 20000.0), ("e", "01", "84", None, 1.0, 1.0, 1.0)],
        "code_insee string, code_departement string, code_region string, population long, "
        "superficie_km2 double, densite double, median_disposable_income double")
    cagr = spark.createDataFrame([("a", "Maison", 2020, 2023, 3, 1.0, 2.0, 0.5)],
                                 "code_commune string, type_local string, first_year int, last_year int, "
                                 "year_span int, first_year_price double, last_year_price double, price_cagr double")
    popc = spark.createDataFrame([], "code_insee string, population_cagr double, first_year long, last_year long")
    tax = spark.createDataFrame([("b", "B", 2024, 73.1)],
                                "code_commune string, nom_commune string, tax_year long, taux_foncier_bati double")
    dep = spark.createDataFrame([("01", "Ain")], "code_departement string, nom_departement string")
    out = by_key(places.commune_opportunity_score(stats, ind, cagr, popc, tax, dep, P, rounded=False),
                 "code_commune")
    # c: population under 2000 -> dropped; d: no indicators -> dropped; e: unknown population -> dropped
    assert set(out) == {("a",), ("b",)}
    a, b = out[("a",)], out[("b",)]
    assert a["national_median_price_per_sqm"] == 900.0  # over all latest-year rows, before the cut
    assert 0 <= b["opportunity_score"] <= 100 and 0 <= a["opportunity_score"] <= 100
    assert b["property_tax_penalty_pts"] == 15.0 and a["property_tax_penalty_pts"] == 0.0
    w = lambda x: x / 90 * 100
    exp_a = ((1 - min(1000 / 900, 2) / 2) * w(20) + (0.15 / 0.15 + 1) / 2 * w(20) + min(20 / 5000 / 0.02, 1) * w(20)
             + (0 / 0.05 + 1) / 2 * w(15) + min(25000 / 30000, 1) * w(15))
    assert math.isclose(a["opportunity_score"], exp_a, rel_tol=1e-12)
    assert math.isclose(a["population_share_of_department"], 5000 / 106500, rel_tol=1e-12)
