"""Landing-shaped raw tables derived from the generated test tables.

The test tables are a TPC-H-like star schema; this module maps them onto the
raw schemas the staging layer expects (all-string sales, typed price bars,
string reference tables, seeds). Every table here is a lazy DataFrame derived
from the parquet scans, so work grows with the data.

Mapping (fixed, shared with the SQL oracle):
  sale key (l_orderkey, l_linenumber); newest by l_shipdate then
    l_partkey, l_suppkey, l_extendedprice, l_quantity (all descending)
  commune l_suppkey / s_name; department s_nationkey / n_name
  property type l_returnflag (kept types A, R); sale kind Adjudication when
    l_linenumber = 7 else Vente; price l_extendedprice; surface l_quantity
  population history: sum(l_quantity) per (l_suppkey, year); current
    population is the commune's latest year
  income s_acctbal * 4, none when s_suppkey % 7 = 0
  tax s_acctbal / 100 for 2000 and s_acctbal / 100 + 1 for 2001, none when
    s_suppkey % 10 = 0
  long bars: ticker l_suppkey, date l_shipdate, newest by l_orderkey,
    l_linenumber, l_partkey; adj_close l_extendedprice / l_quantity,
    dividends l_tax
  short bars: ticker user_id, date of ts, newest by ts then event_id;
    adj_close = value, null for event_type 'error'
  watchlist from supplier; benchmark ticker '1'
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.params import Params

# Fixed values of the mapping.
TEST_PROPERTY_TYPES = ("A", "R")
BENCHMARK_TICKER = "1"
MISSING_BENCHMARK_TICKER = "-1"

TEST_PARAMS = Params(property_types=TEST_PROPERTY_TYPES, benchmark_ticker=BENCHMARK_TICKER)


def version_order() -> tuple:
    """Version order of the mapped sales and short bars: newest first, full tiebreak last."""
    return (F.col("_ingested_at").desc(), F.col("_tiebreak").desc())


#: the key of a long bar in the rows of ``bar_rows``
BAR_ROW_KEY = ("l_suppkey", "date")


def bar_row_order() -> tuple:
    """Version order of the rows of :func:`bar_rows`; the load time of a long bar grows with its order."""
    return tuple(F.col(c).desc() for c in ("l_orderkey", "l_linenumber", "l_partkey"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one test table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _s(c) -> F.Column:
    return c.cast("string")


#: the sale key in the rows of ``sales_rows``
SALES_ROW_KEY = ("l_orderkey", "l_linenumber")


def row_order() -> tuple:
    """Version order of the rows of :func:`sales_rows`, the same as ``version_order`` of the sales mapped from them."""
    return tuple(F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"))


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sales are mapped from, but for the supplier."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_returnflag")


def with_supplier(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines with the name and the nation of their supplier."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return lines.join(sup, lines.l_suppkey == sup.s_suppkey, "left").drop("s_suppkey")


def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sales are mapped from, as numbers: narrow rows to rank or shuffle before the mapping."""
    return with_supplier(spark, sf_dir, line_rows(spark, sf_dir))


def as_raw_transactions(rows: DataFrame) -> DataFrame:
    """Sales landing table of ``sales_rows``: every business column a string, plus lineage."""
    return rows.select(
        _s(F.col("l_orderkey")).alias("id_mutation"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_mutation"),
        F.when(F.col("l_linenumber") == 7, "Adjudication").otherwise("Vente").alias("nature_mutation"),
        _s(F.col("l_extendedprice")).alias("valeur_fonciere"),
        _s(F.col("l_suppkey")).alias("code_commune"),
        F.col("s_name").alias("nom_commune"),
        _s(F.col("s_nationkey")).alias("code_departement"),
        F.concat(F.lit("P"), _s(F.col("l_orderkey"))).alias("id_parcelle"),
        F.col("l_returnflag").alias("type_local"),
        _s(F.col("l_quantity")).alias("surface_reelle_bati"),
        _s(F.col("l_linenumber")).alias("nombre_pieces_principales"),
        _s(F.col("l_discount") * 100).alias("surface_terrain"),
        F.lit(None).cast("string").alias("longitude"),
        F.lit(None).cast("string").alias("latitude"),
        _s(F.col("l_linenumber")).alias("numero_disposition"),
        _s(F.col("s_nationkey")).alias("source_departement"),
        F.year("l_shipdate").alias("source_year"),
        F.col("l_shipdate").alias("_ingested_at"),  # wall clock, no zone: order is zone-free
        F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity").alias("_tiebreak"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales landing table: every business column a string, plus lineage."""
    return as_raw_transactions(sales_rows(spark, sf_dir))


def bar_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the long bars are mapped from, as numbers: narrow rows to rank before the mapping."""
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("date"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("px"),
        "l_quantity", "l_tax", "l_orderkey", "l_linenumber", "l_partkey")


def as_raw_equity_prices(rows: DataFrame) -> DataFrame:
    """Long daily bars landing table of ``bar_rows``: one ticker per supplier, re-delivered copies included."""
    return rows.select(
        _s(F.col("l_suppkey")).alias("ticker"),
        "date",
        F.col("px").alias("open"),
        F.col("px").alias("high"),
        F.col("px").alias("low"),
        F.col("px").alias("close"),
        F.col("px").alias("adj_close"),
        F.col("l_quantity").alias("volume"),
        F.col("l_tax").alias("dividends"),
        F.lit(0.0).alias("stock_splits"),
        F.timestamp_seconds(F.col("l_orderkey")).alias("_ingested_at"),
        F.col("l_linenumber").alias("_linenumber"),
        F.col("l_partkey").alias("_partkey"),
    )


def raw_alternative_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short daily bars (one ticker per user), some with a null price."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        _s(F.col("user_id")).alias("ticker"),
        F.to_date("ts").alias("date"),
        F.col("value").alias("open"),
        F.col("value").alias("high"),
        F.col("value").alias("low"),
        F.col("value").alias("close"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("adj_close"),
        F.lit(None).cast("double").alias("volume"),
        F.lit(None).cast("double").alias("dividends"),
        F.lit(None).cast("double").alias("stock_splits"),
        F.col("ts").alias("_ingested_at"),
        F.struct("event_id").alias("_tiebreak"),
    )


def raw_population_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")  # aggregated map-side right away
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    per_year = li.groupBy("l_suppkey", F.year("l_shipdate").alias("yr")).agg(
        F.sum("l_quantity").cast("bigint").alias("pop")
    )
    j = per_year.join(sup, per_year.l_suppkey == sup.s_suppkey, "left")
    return j.select(
        _s(F.col("l_suppkey")).alias("codgeo"),
        F.col("s_name").alias("libgeo"),
        _s(F.col("s_nationkey")).alias("coddep"),
        _s(F.col("yr")).alias("annee_rp"),
        _s(F.col("pop")).alias("pmun"),
    )


def raw_population(spark: SparkSession, sf_dir: str, hist: DataFrame | None = None) -> DataFrame:
    """Current population per commune: its latest year of the history."""
    hist = hist if hist is not None else raw_population_history(spark, sf_dir)
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    latest = hist.groupBy("codgeo").agg(
        F.max_by(F.struct("pmun", "coddep"), F.col("annee_rp").cast("int")).alias("cur")
    )
    area = (F.col("codgeo").cast("bigint") % 50 + 1).cast("double")
    pop = F.col("cur.pmun").cast("double")
    j = latest.join(nat, F.col("cur.coddep").cast("int") == nat.n_nationkey, "left")
    return j.select(
        F.col("codgeo").alias("code_insee"),
        F.col("cur.pmun").alias("population"),
        _s(area).alias("superficie_km2"),
        _s(pop / area).alias("densite"),
        F.col("cur.coddep").alias("dep_code"),
        _s(F.col("n_regionkey")).alias("reg_code"),
    )


def raw_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    return sup.select(
        _s(F.col("s_suppkey")).alias("code_geographique"),
        F.col("s_name").alias("libelle_geographique"),
        F.when(F.col("s_suppkey") % 7 != 0, _s(F.col("s_acctbal") * 4)).alias("disp_mediane"),
    )


def raw_property_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    years = [(2000, 0.0), (2001, 1.0)]
    parts = [
        sup.select(
            _s(F.col("s_suppkey")).alias("insee_com"),
            F.col("s_name").alias("libcom"),
            F.lit(str(y)).alias("exercice"),
            F.when(F.col("s_suppkey") % 10 != 0, _s(F.col("s_acctbal") / 100 + F.lit(add))).alias("taux_global_tfb"),
        )
        for y, add in years
    ]
    return parts[0].unionByName(parts[1])


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    nat = table(spark, sf_dir, "nation")
    return nat.select(
        _s(F.col("n_nationkey")).alias("code_departement"), F.col("n_name").alias("nom_departement")
    )


def equity_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    return sup.select(
        _s(F.col("s_suppkey")).alias("ticker"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 8 == 0, "etf").otherwise("stock").alias("asset_type"),
        F.concat(F.lit("sector_"), _s(F.col("s_nationkey") % 5)).alias("sector"),
        (F.col("s_acctbal") > 0).alias("pea_eligible"),
        F.col("s_name").alias("isin"),
    )


def alternatives_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return sup.select(
        _s(k).alias("ticker"),
        F.col("s_name").alias("name"),
        F.when(k % 2 == 0, "crypto").otherwise("gold").alias("asset_class"),
        F.when(k % 4 < 2, "spot").otherwise("etf").alias("instrument_type"),
        F.when(k % 3 == 0, "illiquid").when(k % 3 == 1, "medium").otherwise("liquid").alias("liquidity"),
    )
