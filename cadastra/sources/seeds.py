"""Seeds (S16): small dimension CSVs read with explicit schemas.

Codes stay strings (department codes such as 2A and 01 must not become
numbers). Seeds are bounded lists, so joins against them may broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEPARTMENTS = T.StructType([
    T.StructField("code_departement", T.StringType()),
    T.StructField("nom_departement", T.StringType()),
])
EQUITY_WATCHLIST = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("asset_type", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("pea_eligible", T.BooleanType()),
    T.StructField("isin", T.StringType()),
])
ALTERNATIVES_WATCHLIST = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("asset_class", T.StringType()),
    T.StructField("instrument_type", T.StringType()),
    T.StructField("liquidity", T.StringType()),
])


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def tickers(watchlist: DataFrame) -> DataFrame:
    """Distinct non-null tickers of a watchlist."""
    return watchlist.select("ticker").where(F.col("ticker").isNotNull()).distinct()
