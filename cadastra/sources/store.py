"""The landing store: raw tables by source, with declared schemas.

Event-like tables (sales, daily bars) are appended: every load is a partition
of its own, so landing a load again replaces that load and nothing else.
Reference tables are replaced; where they are partitioned (census year, tax
year), only the delivered partitions are.

A table is read by its declared columns: a column that a load lacks is null,
and columns a load has beyond them stay in its files (``every_column`` shows
them, with the files' schemas merged). Text stays text until staging casts it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.sources import landing
from cadastra.sources.files import gzip_faults


@dataclass(frozen=True)
class RawTable:
    columns: tuple[str, ...]
    types: dict[str, str]  # columns that are not text
    partition_by: tuple[str, ...] = ()
    appended: bool = False

    def schema(self) -> str:
        names = [*self.columns, "_ingested_at", *(["load_id"] if self.appended else [])]
        kinds = {**self.types, "_ingested_at": "timestamp"}
        return ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in names)


_BAR = ("open", "high", "low", "close", "adj_close", "volume", "dividends", "stock_splits")
_BARS = RawTable(("ticker", "date", *_BAR), {"date": "date", **dict.fromkeys(_BAR, "double")}, appended=True)

#: the raw tables by name
TABLES = {
    "transactions": RawTable(
        ("id_mutation", "date_mutation", "nature_mutation", "valeur_fonciere", "code_commune", "nom_commune",
         "code_departement", "id_parcelle", "type_local", "surface_reelle_bati", "nombre_pieces_principales",
         "surface_terrain", "longitude", "latitude", "numero_disposition", "source_departement", "source_year"),
        {"source_year": "int"}, appended=True),
    "equity_prices": _BARS,
    "alternative_prices": _BARS,
    "commune_population": RawTable(
        ("code_insee", "population", "superficie_km2", "densite", "dep_code", "reg_code"), {}),
    "commune_income": RawTable(("code_geographique", "libelle_geographique", "disp_mediane"), {}),
    "commune_population_history": RawTable(
        ("codgeo", "libgeo", "coddep", "annee_rp", "pmun"), {}, partition_by=("annee_rp",)),
    "commune_property_tax": RawTable(
        ("insee_com", "libcom", "exercice", "taux_global_tfb"), {}, partition_by=("exercice",)),
}


class RawStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def write(self, table: str, df: DataFrame, batch_ts: datetime, load_id: str | None = None) -> int:
        """Land a load; returns its rows. An appended table needs the ``load_id``."""
        t = TABLES[table]
        if t.appended and not load_id:
            raise ValueError(f"{table} is appended by load: give the load_id")
        have = set(df.columns)
        declared = [(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t.types.get(c, "string")).alias(c) for c in t.columns]
        extra = [F.col(f"`{c}`") for c in df.columns if c not in t.columns]
        df = landing.stamp(df.select(*declared, *extra), batch_ts)
        if t.appended:
            return landing.replace(df.withColumn("load_id", F.lit(load_id)), self.path(table), ["load_id"], only_delivered=True)
        return landing.replace(df, self.path(table), t.partition_by, only_delivered=bool(t.partition_by))

    def read(self, table: str, every_column: bool = False) -> DataFrame:
        """The raw table by its declared columns; without any load, no rows."""
        t = TABLES[table]
        try:
            reader = self.spark.read.option("mergeSchema", True) if every_column else self.spark.read.schema(t.schema())
            return reader.parquet(self.path(table))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], t.schema())


def land_sales(store: RawStore, delivered: str, expected: DataFrame, load_id: str, batch_ts: datetime,
               layout: str = "files") -> DataFrame:
    """Land every delivered sales file; report each expected pair.

    ``expected`` has code_departement and year. The report says of each pair
    ``landed``, ``empty`` (a file without rows), ``missing`` (no file) or
    ``damaged``, with its rows and the fault. A damaged file does not end the
    load: the load is written as if all files were sound, and only if that
    fails are the files unpacked one by one, the pairs of damaged ones set
    aside whole, and the rest written. Only when every expected pair is damaged
    is the load an error.
    """
    spark = store.spark
    files = landing.delivered_files(spark, delivered, layout)
    faults: dict[tuple[str, int], str] = {}

    def write() -> None:
        sound = [f for f, pair in files.items() if pair is not None and pair not in faults]
        store.write("transactions", landing.read_sales_csv(spark, delivered, layout, sound), batch_ts, load_id)

    try:
        write()
    except (Py4JJavaError, PySparkException):
        faults = {files[f]: why for f, why in gzip_faults(spark, list(files)).items() if files.get(f)}
        if not faults:  # not the files' fault
            raise
        write()
    pairs = sorted({(*pair, faults.get(pair)) for pair in files.values() if pair}, key=str)
    seen = spark.createDataFrame(pairs, "code_departement string, year int, fault string")  # a row per delivered pair
    landed = store.read("transactions").where(F.col("load_id") == load_id).groupBy(
        F.col("source_departement").alias("code_departement"), F.col("source_year").alias("year")).agg(
        F.count(F.lit(1)).alias("rows_landed"))
    key = ["code_departement", "year"]
    report = expected.select("code_departement", F.col("year").cast("int").alias("year")).join(
        seen.withColumn("_file", F.lit(True)), key, "left").join(landed, key, "left")
    report = report.select(
        *key,
        F.when(F.col("_file").isNull(), "missing").when(F.col("fault").isNotNull(), "damaged")
        .when(F.col("rows_landed").isNull(), "empty").otherwise("landed").alias("status"),
        F.coalesce("rows_landed", F.lit(0)).cast("bigint").alias("rows_landed"), "fault")
    if faults and report.where("status <> 'damaged'").limit(1).count() == 0:
        raise RuntimeError(f"all {len(faults)} expected (department, year) files are damaged, the first: {min(faults.items())}")
    return report
