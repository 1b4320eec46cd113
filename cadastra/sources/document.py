"""The nested assumptions document (S20) as one ordered run of lines.

The lists of the document grow with the watchlists and the departments, so the
document is a distributed table of lines: fixed parts and list rows, each with
its place. Written in that order, its part files one after the other are the
JSON document; no task holds a whole list. ``read`` gives a written document
back as such a table, ``rows`` and ``header`` parse it line by line. ``text``
joins the lines into one value behind a counted bound, for documents known to
be small.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.operators import assumptions
from cadastra.operators.joins import attach_one_row
from cadastra.operators.materialize import materialize
from cadastra.operators.ordinal import with_ordinal
from cadastra.params import DEFAULT, Params

_KEEP_NULLS = {"ignoreNullFields": "false"}

#: what is in the document, as a schema to parse it with
SCHEMA = """
exported_at string,
equities struct<
  blended_default: struct<annualized_return: double, annualized_volatility: double, method: string>,
  etf_blended_default: struct<annualized_return: double, annualized_volatility: double, method: string>,
  pea_eligible: array<struct<ticker: string, name: string, asset_type: string, trading_days: bigint,
                             annualized_return: double, annualized_volatility: double>>>,
alternatives struct<
  blended_default: struct<annualized_return: double, annualized_volatility: double, method: string>,
  liquid_blended_default: struct<annualized_return: double, annualized_volatility: double, method: string>,
  watchlist: array<struct<ticker: string, name: string, asset_class: string, instrument_type: string, liquidity: string,
                          trading_days: bigint, annualized_return: double, annualized_volatility: double>>>,
real_estate struct<national_median_price_cagr: double, national_median_price_cagr_is_fallback: boolean,
  by_department: array<struct<code_departement: string, nom_departement: string, median_price_cagr: double>>>,
growth struct<pea_growth_rate: double, real_estate_growth_rate: double, alternatives_growth_rate: double>
"""

#: the lists by their part: where they stand in the document
LISTS = {1: ("equities", "pea_eligible"), 3: ("alternatives", "watchlist"), 5: ("real_estate", "by_department")}


def _json(*cols) -> Column:
    return F.to_json(F.struct(*cols), _KEEP_NULLS)


def _blend(prefix: str) -> Column:
    return _json(*[F.col(f"{prefix}_{c}").alias(c) for c in ("annualized_return", "annualized_volatility", "method")])


def _fixed_parts(exported_at: datetime) -> list[tuple[int, Column]]:
    """(place, text) of the parts around the lists; the lists have the odd places."""
    head = F.lit('{"exported_at": "' + exported_at.isoformat() + '", "equities": {"blended_default": ')
    return [
        (0, F.concat(head, _blend("equity"), F.lit(', "etf_blended_default": '), _blend("etf"), F.lit(', "pea_eligible": ['))),
        (2, F.concat(F.lit(']}, "alternatives": {"blended_default": '), _blend("alternatives"),
                     F.lit(', "liquid_blended_default": '), _blend("liquid"), F.lit(', "watchlist": ['))),
        (4, F.concat(F.lit(']}, "real_estate": {"national_median_price_cagr": '),
                     F.coalesce(F.col("national_median_price_cagr").cast("string"), F.lit("null")),
                     F.lit(', "national_median_price_cagr_is_fallback": '),
                     F.col("national_median_price_cagr_is_fallback").cast("string"), F.lit(', "by_department": ['))),
        (6, F.concat(F.lit(']}, "growth": '),
                     _json("pea_growth_rate", "real_estate_growth_rate", "alternatives_growth_rate"), F.lit("}"))),
    ]


def lines(equity_summary: DataFrame, alt_summary: DataFrame, dept_score: DataFrame, exported_at: datetime,
          p: Params = DEFAULT) -> DataFrame:
    """The document's lines: part, at (place within the part), line."""
    rates = assumptions.growth_assumptions(
        assumptions.equity_blends(equity_summary, p), assumptions.alternatives_blends(alt_summary, p),
        assumptions.national_median_cagr(dept_score, p), p)  # one row
    parts = F.array(*[F.struct(F.lit(k).alias("part"), F.lit(0).cast("bigint").alias("at"), text.alias("line"))
                      for k, text in _fixed_parts(exported_at)])
    out = rates.select(F.explode(parts).alias("_p")).select("_p.*")
    lists = assumptions.assumptions_lists(equity_summary, alt_summary, dept_score)
    for part, (name, rows) in zip((1, 3, 5), lists.items()):
        key = "code_departement" if name == "real_estate_by_department" else "ticker"
        cols = rows.columns
        placed = with_ordinal(rows, [F.col(key).asc_nulls_first(), *[F.col(c) for c in cols if c != key]], "at")
        comma = F.when(F.col("at") > 1, ", ").otherwise("")  # a separator before every row but the first
        out = out.unionByName(placed.select(F.lit(part).alias("part"), "at", F.concat(comma, _json(*cols)).alias("line")))
    return out


def write(document: DataFrame, path: str) -> None:
    """Write the lines in order; the part files, joined in the order of their names, are the document."""
    order = ["part", "at"]
    document.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a written document: part, at (place within the part), line, as ``lines`` gave them.

    Lines are placed by file and by where they stand in it. The part follows
    from the fixed lines before a line: the first one, and those that end a list.
    """
    found = spark.read.text(path).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"),
        F.col("value").alias("line"))
    placed = with_ordinal(found, [F.col("_file"), F.col("_block"), F.col("_row")], "_place")
    is_fixed = (F.col("_place") == 1) | F.col("line").startswith("]")  # a list row starts with a brace or a comma
    fixed = placed.where(is_fixed).agg(F.array_sort(F.collect_list("_place")).alias("_fixed"))  # four places
    placed = attach_one_row(placed, fixed)
    n = F.size(F.filter("_fixed", lambda x: x <= F.col("_place")))
    whole = F.when(F.size("_fixed") == len(LISTS) + 1, n).otherwise(F.raise_error(F.lit("not a whole document")).cast("int"))
    return materialize(placed.select(
        F.when(is_fixed, 2 * whole - 2).otherwise(2 * whole - 1).alias("part"),
        (F.col("_place") - F.element_at("_fixed", n)).alias("at"), "line"))


def rows(document: DataFrame, part: int) -> DataFrame:
    """The rows of one list, parsed: place (from 0), x; an error where a separator is missing or a row is no JSON."""
    outer, name = LISTS[part]
    of_row = T.StructType.fromDDL(SCHEMA)[outer].dataType[name].dataType.elementType
    row = F.regexp_extract("line", r"(?s)^(, )?(\{.*\})$", 2)
    split = F.when(F.col("at") > 1, F.col("line").startswith(", ")).otherwise(F.col("line").startswith("{"))
    checked = F.when(split, row).otherwise(F.raise_error(F.concat(F.lit("no row of a list: "), "line")))
    return document.where(F.col("part") == part).select(
        (F.col("at") - 1).alias("place"), F.from_json(checked, of_row, {"mode": "FAILFAST"}).alias("x"))


def header(document: DataFrame) -> DataFrame:
    """The document without the rows of its lists, parsed: one row."""
    parts = document.where(~F.col("part").isin(*LISTS)).agg(F.array_sort(F.collect_list(F.struct("part", "line"))).alias("_p"))
    whole = F.concat_ws("", F.transform("_p", lambda x: x["line"]))
    return parts.select(F.from_json(whole, SCHEMA, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def text(document: DataFrame, max_lines: int = 100_000) -> DataFrame:
    """The whole document as one value; an error if it has more than ``max_lines`` lines."""
    n = document.count()
    if n > max_lines:
        raise ValueError(f"the document has {n} lines, more than {max_lines}: write it instead")
    whole = F.array_sort(F.collect_list(F.struct("part", "at", "line")))
    return document.agg(F.concat_ws("\n", F.transform(whole, lambda x: x["line"])).alias("document"))
