import random
from datetime import datetime

from pyspark.sql import functions as F

from cadastra.operators.dedupe import latest_wins
from cadastra.operators.staging import stg_prices, stg_transactions

SALE_COLS = ["id_mutation", "date_mutation", "nature_mutation", "valeur_fonciere", "code_commune", "nom_commune",
             "code_departement", "id_parcelle", "type_local", "surface_reelle_bati", "nombre_pieces_principales",
             "surface_terrain", "longitude", "latitude", "numero_disposition", "source_departement"]


def sale(id_, ts, price="100000", surface="50", **kw):
    base = dict(id_mutation=id_, date_mutation="2023-05-01", nature_mutation="Vente", valeur_fonciere=price,
                code_commune="01001", nom_commune="A", code_departement="01", id_parcelle="p" + id_,
                type_local="Maison", surface_reelle_bati=surface, nombre_pieces_principales="3",
                surface_terrain=None, longitude=None, latitude=None, numero_disposition="1",
                source_departement="01")
    base.update(kw)
    return tuple(base[c] for c in SALE_COLS) + (2023, datetime(2024, 1, ts))


def sales_frame(spark, rows):
    schema = ", ".join(f"{c} string" for c in SALE_COLS) + ", source_year int, _ingested_at timestamp"
    return spark.createDataFrame(rows, schema)


def test_latest_version_wins_and_bad_text_survives_as_null(spark):
    rows = [sale("1", 1, price="1"), sale("1", 3, price="300000"), sale("1", 2, price="200000"),
            sale("2", 1, price="abc"),          # unparseable price: kept, null after the cast
            sale("3", 1, price=None),           # null raw price: dropped
            sale("4", 1, surface="0"),          # zero surface: dropped
            sale("5", 1, surface="x")]          # unparseable surface: dropped
    out = {r["id_mutation"]: r for r in stg_transactions(sales_frame(spark, rows)).collect()}
    assert set(out) == {"1", "2"}
    assert out["1"]["valeur_fonciere"] == 300000.0
    assert out["2"]["valeur_fonciere"] is None
    assert str(out["1"]["date_mutation"]) == "2023-05-01"


def test_dedupe_is_order_independent_and_idempotent(spark):
    rnd = random.Random(1)
    rows = [(k, v, float(rnd.random())) for k in range(50) for v in range(rnd.randint(1, 6))]
    df = spark.createDataFrame(rows, "k int, v int, x double")
    order = [F.col("v").desc()]
    a = sorted(latest_wins(df, ["k"], order).collect())
    rnd.shuffle(rows)
    b = sorted(latest_wins(spark.createDataFrame(rows, df.schema), ["k"], order).collect())
    assert a == b
    again = sorted(latest_wins(latest_wins(df, ["k"], order), ["k"], order).collect())
    assert a == again
    assert all(r["v"] == max(v for k, v, _ in rows if k == r["k"]) for r in a)


def bars(spark, rows):
    return spark.createDataFrame(rows, "ticker string, date string, open double, high double, low double, "
                                       "close double, adj_close double, volume double, dividends double, "
                                       "stock_splits double, _ingested_at timestamp")


def test_newest_null_price_removes_the_day(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [("X", "2024-01-01", 1.0, 1.0, 1.0, 1.0, 10.0, 5.0, 0.0, 0.0, t1),
            ("X", "2024-01-01", None, None, None, None, None, None, None, None, t2),  # newer placeholder
            ("X", "2024-01-02", 1.0, 1.0, 1.0, 1.0, float("nan"), 5.0, 0.0, 0.0, t1),  # NaN price
            ("X", "2024-01-03", 1.0, 1.0, 1.0, 1.0, 11.0, 5.0, 0.5, 0.0, t1)]
    out = stg_prices(bars(spark, rows)).collect()
    assert [str(r["date"]) for r in out] == ["2024-01-03"]
    assert out[0]["volume"] == 5 and out[0]["dividends"] == 0.5


def test_sales_are_ranked_as_narrow_rows(spark):
    from cadastra.plans.inputs import Inputs

    plan = Inputs(spark, "/root/testdata/sf0.001").sales._jdf.queryExecution().optimizedPlan().toString()
    above, ranked = plan.split("WindowGroupLimit", 1)  # what is below is shuffled
    assert "AS id_parcelle" in above and "id_parcelle" not in ranked and "struct" not in ranked


def test_raw_text_is_cast_before_the_dedupe(spark):
    frame = sales_frame(spark, [sale("1", 1, price="5"), sale("1", 2, price=None), sale("2", 1, price="abc"), sale("2", 0 + 2, price="7")])
    out = stg_transactions(frame)
    ranked = out._jdf.queryExecution().optimizedPlan().toString().split("WindowGroupLimit", 1)[1]
    assert "try_cast" in ranked.lower() or "as double" in ranked.lower()
    assert [(r["id_mutation"], r["valeur_fonciere"]) for r in out.collect()] == [("2", 7.0)]  # a newest version without a price goes


def test_bars_are_ranked_as_numbers(spark):
    from cadastra.plans.inputs import Inputs

    plan = Inputs(spark, "/root/testdata/sf0.001").equity_prices._jdf.queryExecution().optimizedPlan().toString()
    above, ranked = plan.split("WindowGroupLimit", 1)  # what is below is shuffled
    assert "as string" in above and "as string" not in ranked


def test_filtered_sale_columns_are_cast_once(spark):
    from cadastra.operators.places import qualifying_sales

    cols = "k string, _v int, " + ", ".join(f"{c} string" for c in SALE_COLS) + ", source_year int, _ingested_at timestamp"
    rows = [("a", 1, *sale("1", 1, price="100000")), ("a", 2, *sale("1", 1, price="200000")),
            ("b", 1, *sale("2", 1, price="x")), ("c", 1, *sale("3", 1, price=None)), ("d", 1, *sale("4", 1, surface="0")),
            ("e", 1, *sale("5", 1, surface="1d")), ("f", 1, *sale("6", 1, price="60000", surface=" 2e1 "))]
    staged = stg_transactions(spark.createDataFrame(rows, cols), (F.col("_v").desc(),), ("k",), lambda d: d.drop("k", "_v"))
    assert [f.dataType.simpleString() for f in staged.schema.fields if f.name in ("valeur_fonciere", "surface_reelle_bati")] == ["double"] * 2
    assert sorted((r["id_mutation"], r["valeur_fonciere"], r["surface_reelle_bati"]) for r in staged.collect()) == [
        ("1", 200000.0, 50.0), ("2", None, 50.0), ("6", 60000.0, 20.0)]
    out = qualifying_sales(staged)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 2  # once for the price, once for the surface
    assert sorted(r["price_per_sqm"] for r in out.collect()) == [3000.0, 4000.0]
