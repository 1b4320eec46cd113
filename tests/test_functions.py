import math

from pyspark.sql import functions as F

from cadastra.functions import (
    clamp_or_fallback,
    finite_or_null,
    nan_to_null,
    normalize_column_name,
    safe_div,
    safe_pow,
    strict_greatest,
    strict_least,
)


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_safe_div(spark):
    assert one(spark, safe_div(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, safe_div(F.lit(None).cast("double"), F.lit(2.0))) is None
    assert one(spark, safe_div(F.lit(3), F.lit(2))) == 1.5


def test_safe_pow_non_finite_is_null(spark):
    assert one(spark, safe_pow(F.lit(-2.0), F.lit(0.5))) is None  # NaN in Spark
    assert one(spark, safe_pow(F.lit(0.0), F.lit(-1.0))) is None  # Infinity in Spark
    assert one(spark, safe_pow(F.lit(4.0), F.lit(0.5))) == 2.0


def test_strict_least_greatest_null(spark):
    # Spark's least/greatest skip nulls; the warehouse semantics return null
    assert one(spark, F.least(F.lit(None).cast("double"), F.lit(2.0))) == 2.0
    assert one(spark, strict_least(F.lit(None).cast("double"), F.lit(2.0))) is None
    assert one(spark, strict_greatest(F.lit(1.0), F.lit(None).cast("double"))) is None
    assert one(spark, strict_least(F.lit(3.0), F.lit(2.0))) == 2.0


def test_nan_handling(spark):
    assert one(spark, nan_to_null(F.lit(float("nan")))) is None
    assert one(spark, finite_or_null(F.lit(float("inf")))) is None
    assert one(spark, finite_or_null(F.lit(1.5))) == 1.5


def test_clamp_or_fallback(spark):
    assert one(spark, clamp_or_fallback(F.lit(None).cast("double"), 0.2, 0.07)) == 0.07
    assert one(spark, clamp_or_fallback(F.lit(float("nan")), 0.2, 0.07)) == 0.07
    assert one(spark, clamp_or_fallback(F.lit(0.5), 0.2, 0.07)) == 0.2
    assert one(spark, clamp_or_fallback(F.lit(-0.5), 0.2, 0.07)) == -0.2
    assert math.isclose(one(spark, clamp_or_fallback(F.lit(0.1), 0.2, 0.07)), 0.1)


def test_decimal_literals_lose_digits_but_floats_do_not(spark):
    # written as SQL text the weight is a decimal with 6 digits; as a Python float it is exact
    dec = spark.sql("SELECT 20.0/90*100 AS x").first()["x"]
    assert float(dec) != 20.0 / 90 * 100
    assert one(spark, F.lit(20.0 / 90 * 100)) == 20.0 / 90 * 100


def test_header_names():
    assert normalize_column_name(" Valeur Foncière ") == "valeur_fonciere"
    assert normalize_column_name("Adj Close") == "adj_close"
    assert normalize_column_name("CODGEO") == "codgeo"
    assert normalize_column_name("2021 pop") == "c_2021_pop"
    assert normalize_column_name("--") == "col"
    assert normalize_column_name("a  -- b__c") == "a_b_c"
    assert normalize_column_name("Numéro_de_Département") == "numero_de_departement"
