"""Marts from landed files: inputs over a landing store, and the delivery of the test tables.

``LandedInputs`` builds every staged table from the store's raw tables and the
seed files, so ``python -m cadastra --landed`` and the marts need no other
source. ``deliver`` writes the test tables in the layout in which the sources
publish them (see ``sources/testdata.py`` for the mapping).
"""

from __future__ import annotations

import gzip
import os
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastra.operators import staging
from cadastra.operators.materialize import materialize
from cadastra.params import DEFAULT, Params
from cadastra.plans.inputs import Inputs
from cadastra.session import parallelism
from cadastra.sources import landing, seeds
from cadastra.sources import testdata as td
from cadastra.sources.store import RawStore

#: loads of the test tables: corrections replace earlier versions, so the later load wins
FIRST_LOAD = ("load-1", datetime(2024, 1, 1))
SECOND_LOAD = ("load-2", datetime(2024, 2, 1))


class LandedInputs(Inputs):
    """Staged tables and marts over ``<root>/raw`` (the store) and ``<root>/seeds``."""

    def __init__(self, spark: SparkSession, root: str, params: Params = DEFAULT):
        super().__init__(spark, root, params)
        self.store = RawStore(spark, os.path.join(root, "raw"))

    def _seed(self, name: str, schema) -> DataFrame:
        return seeds.read_seed(self.spark, os.path.join(self.sf, "seeds", name), schema)

    @cached_property
    def sales(self) -> DataFrame:
        return staging.stg_transactions(self.store.read("transactions"))

    @cached_property
    def equity_prices(self) -> DataFrame:
        return staging.stg_prices(self.store.read("equity_prices"))

    @cached_property
    def alt_prices(self) -> DataFrame:
        return staging.stg_prices(self.store.read("alternative_prices"))

    @cached_property
    def raw_population_history(self) -> DataFrame:
        return self.store.read("commune_population_history")

    @cached_property
    def population(self) -> DataFrame:
        return staging.stg_population(self.store.read("commune_population"))

    @cached_property
    def income(self) -> DataFrame:
        return staging.stg_income(self.store.read("commune_income"))

    @cached_property
    def tax(self) -> DataFrame:
        return staging.stg_property_tax(self.store.read("commune_property_tax"))

    @cached_property
    def departments(self) -> DataFrame:
        return self._seed("departements", seeds.DEPARTMENTS)

    @cached_property
    def equity_watchlist(self) -> DataFrame:
        return self._seed("pea_watchlist", seeds.EQUITY_WATCHLIST)

    @cached_property
    def alt_watchlist(self) -> DataFrame:
        return self._seed("alternatives_watchlist", seeds.ALTERNATIVES_WATCHLIST)


_SALES_HEADERS = {
    "id_mutation": "Id Mutation", "valeur_fonciere": "Valeur Foncière", "surface_reelle_bati": "Surface réelle bâti",
    "code_departement": "Code Département", "numero_disposition": "Numéro Disposition",
}


def deliver_sales(raw: DataFrame, root: str, reverse: bool = False, spread: bool = True) -> None:
    """Sales as gzip CSV per (year, department); ``reverse`` turns the order of the columns.

    ``spread=False``: the rows of a (year, department) are already together.
    """
    lineage = ["source_year", "source_departement"]
    cols = [c for c in raw.columns if c not in lineage and not c.startswith("_")]
    cols = cols[::-1] if reverse else cols
    out = raw.select(*[F.col(c).alias(_SALES_HEADERS.get(c, c)) for c in cols],
                     F.col("source_year").alias("year"), F.col("source_departement").alias("dep"))
    out = out.hint("rebalance", parallelism(raw.sparkSession), "year", "dep") if spread else out
    out.write.partitionBy("year", "dep").option("header", True).option("compression", "gzip").csv(root)


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The test sales in two deliveries: all versions but the newest of each key, then the newest.

    Versions are ranked once, over the lines that the sales are mapped from
    (order and line give a sale's key), and written; each delivery brings its
    narrow rows together by (year, department) before they become text.
    """
    newest = Window.partitionBy(*td.SALES_ROW_KEY).orderBy(*td.row_order())
    ranked = materialize(td.line_rows(spark, sf).withColumn("_n", F.row_number().over(newest)))

    def together(lines: DataFrame) -> DataFrame:
        rows = td.with_supplier(spark, sf, lines).withColumn("_year", F.year("l_shipdate"))
        return td.as_raw_transactions(rows.hint("rebalance", parallelism(spark), "_year", "s_nationkey"))

    return together(ranked.where("_n > 1")), together(ranked.where("_n = 1"))


def deliver(spark: SparkSession, sf: str, root: str) -> None:
    """Write the test tables as delivered files under ``root``."""
    older, newest = _versions(spark, sf)
    deliver_sales(older, f"{root}/sales-1", spread=False)
    deliver_sales(newest.withColumn("millesime", F.lit("2")), f"{root}/sales-2", reverse=True, spread=False)  # other columns, other order
    history = td.raw_population_history(spark, sf)
    history.write.parquet(f"{root}/population_history")
    history = spark.read.parquet(f"{root}/population_history")
    semicolons = {"header": True, "sep": ";", "encoding": "ISO-8859-1"}
    td.raw_population(spark, sf, history).write.options(**semicolons).csv(f"{root}/population")
    td.raw_income(spark, sf).withColumnRenamed("libelle_geographique", "Libellé géographique").write.options(
        **semicolons).csv(f"{root}/income")
    td.raw_property_tax(spark, sf).write.option("header", True).csv(f"{root}/tax")
    for name, rows in {"departements": td.departments, "pea_watchlist": td.equity_watchlist,
                       "alternatives_watchlist": td.alternatives_watchlist}.items():
        rows(spark, sf).write.option("header", True).csv(f"{root}/seeds/{name}")


def land(spark: SparkSession, delivered: str, root: str, expected: DataFrame) -> list[DataFrame]:
    """Land everything ``deliver`` wrote into the store under ``root``; the load report of each sales delivery."""
    from cadastra.sources.store import land_sales

    store = RawStore(spark, os.path.join(root, "raw"))
    reports = [land_sales(store, f"{delivered}/sales-{k}", expected, load_id, ts, layout="hive")
               for k, (load_id, ts) in enumerate((FIRST_LOAD, SECOND_LOAD), 1)]
    ts = SECOND_LOAD[1]
    store.write("commune_population", landing.read_delimited(spark, f"{delivered}/population"), ts)
    store.write("commune_income", landing.read_delimited(spark, f"{delivered}/income"), ts)
    store.write("commune_population_history", landing.read_parquet(spark, f"{delivered}/population_history"), ts)
    store.write("commune_property_tax", landing.read_delimited(spark, f"{delivered}/tax"), ts)
    return reports


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one small file as it is (damaged or empty deliveries of the load report)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target)
    out.write(bytearray(data))
    out.close()


def cut_short(rows: int = 2000) -> bytes:
    """A gzip CSV file that ends before its data."""
    whole = gzip.compress(b"id_mutation,valeur_fonciere\n" + b"".join(b"%d,%d\n" % (i, i * 7919 % 104729) for i in range(rows)))
    return whole[: len(whole) // 2]
