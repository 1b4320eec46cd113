"""Property branch: period statistics, growth rates, score and rollup.

M08 period_stats, M09 price_cagr, M10 commune_indicators, M11
population_cagr, M12 latest_tax, M15 commune_opportunity_score, M16
department_opportunity_score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.safe import safe_div, safe_pow, strict_greatest, strict_least
from cadastra.operators.joins import attach_one_row
from cadastra.operators.dedupe import latest_wins
from cadastra.operators.materialize import known_rows, materialize
from cadastra.operators.median import agg_with_lower_median, agg_with_lower_medians
from cadastra.params import DEFAULT, Params

GROUP = ["code_commune", "code_departement", "type_local", "year"]


def qualifying_sales(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Market sales of the kept property types, with a sane price per m2."""
    ppsqm = safe_div(F.col("valeur_fonciere"), F.col("surface_reelle_bati"))
    return stg.where(
        F.col("type_local").isin(*p.property_types)
        & ~F.col("nature_mutation").isin(*p.excluded_sale_kinds)  # null kind is dropped too
        & ppsqm.between(p.min_price_per_sqm, p.max_price_per_sqm)
    ).select(
        "code_commune",
        "nom_commune",
        "code_departement",
        "type_local",
        F.col("source_year").alias("year"),
        ppsqm.alias("price_per_sqm"),
    )


def commune_year_stats(sales: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Count and exact lower-median price per (commune, department, type, year)."""
    return agg_with_lower_median(
        sales,
        GROUP,
        "price_per_sqm",
        "median_price_per_sqm",
        extra_aggs=[
            F.min("nom_commune").alias("nom_commune"),  # any member; min is repeatable
            F.count(F.lit(1)).alias("transaction_count"),
        ],
        accuracy=p.median_sketch_accuracy,
        max_exact_group=p.median_max_exact_group,
    )


def period_stats(stg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Per-group stats plus the prior year's median and a gated yoy change.

    The prior-year join key leaves out the department on purpose (the
    reference does the same): a commune listed under two departments fans out.
    """
    # the narrow qualifying projection is read by both median passes: write it once
    cur = commune_year_stats(materialize(qualifying_sales(stg, p)), p)
    # Prior-year rows via a one-year RANGE frame: the same fan-out as a left
    # self-join on (commune, type, year - 1), without computing stats twice.
    # The frame holds one row per department of that commune: bounded. A null year,
    # commune or type has no prior year, as in an equi-join.
    w = Window.partitionBy("code_commune", "type_local").orderBy("year").rangeBetween(-1, -1)
    known = F.col("year").isNotNull() & F.col("code_commune").isNotNull() & F.col("type_local").isNotNull()
    prior = F.when(known, F.collect_list(F.struct("median_price_per_sqm", "transaction_count")).over(w))
    j = cur.withColumn("_prior", prior).withColumn("_p", F.explode_outer("_prior")).select(
        *cur.columns,
        F.col("_p.median_price_per_sqm").alias("prior_year_median_price_per_sqm"),
        F.col("_p.transaction_count").alias("_prev_count"),
    )
    yoy = F.when(
        F.col("_prev_count") >= p.min_reliable_transaction_count,
        safe_div(
            F.col("median_price_per_sqm") - F.col("prior_year_median_price_per_sqm"),
            F.col("prior_year_median_price_per_sqm"),
        ),
    )
    return j.select(
        "code_commune",
        "nom_commune",
        "code_departement",
        "type_local",
        "year",
        "transaction_count",
        "median_price_per_sqm",
        "prior_year_median_price_per_sqm",
        yoy.alias("yoy_price_change_pct"),
    )


def _cagr(first, last, span) -> F.Column:
    return safe_pow(safe_div(last, first), safe_div(F.lit(1.0), span)) - F.lit(1.0)


def price_cagr(stats: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """CAGR between the first and last reliable years, span >= 2.

    (commune, type, year) can repeat across departments, so the endpoint
    prices come from equi-joins on the endpoint years, as in the reference.
    """
    reliable = stats.where(F.col("transaction_count") >= p.min_reliable_transaction_count).select(
        "code_commune", "type_local", "year", "median_price_per_sqm"
    )
    ends = (
        reliable.groupBy("code_commune", "type_local")
        .agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))
        .where(F.col("last_year") - F.col("first_year") >= p.min_cagr_span_years)
    )
    first = reliable.select(
        "code_commune", "type_local", F.col("year").alias("first_year"),
        F.col("median_price_per_sqm").alias("first_year_price"),
    )
    last = reliable.select(
        "code_commune", "type_local", F.col("year").alias("last_year"),
        F.col("median_price_per_sqm").alias("last_year_price"),
    )
    j = ends.join(first, ["code_commune", "type_local", "first_year"]).join(
        last, ["code_commune", "type_local", "last_year"]
    )
    span = F.col("last_year") - F.col("first_year")
    return j.select(
        "code_commune",
        "type_local",
        "first_year",
        "last_year",
        span.alias("year_span"),
        "first_year_price",
        "last_year_price",
        _cagr(F.col("first_year_price"), F.col("last_year_price"), span).alias("price_cagr"),
    )


def commune_indicators(population: DataFrame, income: DataFrame) -> DataFrame:
    """Population, area, density and median income per commune."""
    inc = income.select("code_insee", "median_disposable_income")
    return population.join(inc, "code_insee", "left").select(
        "code_insee",
        "code_departement",
        "code_region",
        "population",
        "superficie_km2",
        "densite",
        "median_disposable_income",
    )


def population_cagr(history: DataFrame) -> DataFrame:
    """Population CAGR over each commune's full positive history.

    Endpoint rows are regrouped (the reference guards against duplicate
    (commune, year) rows); ``min`` stands in for ``any_value``.
    """
    h = history.where(F.col("population") > 0)
    ends = (
        h.groupBy("code_insee")
        .agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))
        .where(F.col("last_year") > F.col("first_year"))
    )
    first = h.select(
        "code_insee", F.col("year").alias("first_year"), "nom_commune", "code_departement",
        F.col("population").alias("first_year_population"),
    )
    last = h.select("code_insee", F.col("year").alias("last_year"), F.col("population").alias("last_year_population"))
    j = ends.join(first, ["code_insee", "first_year"]).join(last, ["code_insee", "last_year"])
    g = j.groupBy("code_insee", "first_year", "last_year").agg(
        F.min("nom_commune").alias("nom_commune"),
        F.min("code_departement").alias("code_departement"),
        F.min("first_year_population").alias("first_year_population"),
        F.min("last_year_population").alias("last_year_population"),
    )
    span = F.col("last_year") - F.col("first_year")
    return g.select(
        "code_insee",
        "nom_commune",
        "code_departement",
        "first_year",
        "last_year",
        span.alias("year_span"),
        "first_year_population",
        "last_year_population",
        _cagr(F.col("first_year_population"), F.col("last_year_population"), span).alias("population_cagr"),
    )


def latest_tax(tax: DataFrame) -> DataFrame:
    """Newest tax year per commune (tiebreak on the rate for repeatability)."""
    d = latest_wins(
        tax, ["code_commune"], [F.col("year").desc(), F.col("taux_foncier_bati").desc(), F.col("nom_commune").desc()]
    )
    return d.select("code_commune", "nom_commune", F.col("year").alias("tax_year"), "taux_foncier_bati")


def tax_penalty(rate: F.Column, p: Params = DEFAULT) -> F.Column:
    """K06 before rounding: linear ramp from the threshold to twice it, missing = 0."""
    t = float(p.high_property_tax_threshold_pct)
    over = F.greatest(F.lit(0.0), F.coalesce(rate, F.lit(0.0)) - F.lit(t)) / F.lit(t)
    return F.least(F.lit(1.0), over) * F.lit(float(p.max_property_tax_penalty_pts))


def _weight(w: float, p: Params) -> F.Column:
    return F.lit(w / p.weight_total * 100.0)


def opportunity_points(
    ratio: F.Column, cagr: F.Column, tpc: F.Column, pop_cagr: F.Column, income: F.Column, penalty: F.Column,
    p: Params = DEFAULT,
) -> F.Column:
    """K07 before rounding: five capped factors minus the tax penalty, floored at 0.

    The price ratio is used uncoalesced; its cap goes through the null-strict
    ``least`` so a missing ratio makes the score null, as in the warehouse.
    """
    mc, mp = float(p.max_price_cagr_pct), float(p.max_population_cagr_pct)
    price_pts = (F.lit(1.0) - strict_least(ratio, F.lit(2.0)) / F.lit(2.0)) * _weight(p.weight_price, p)
    growth = F.least(F.greatest(F.coalesce(cagr, F.lit(0.0)), F.lit(-mc)), F.lit(mc))
    growth_pts = (growth / F.lit(mc) + F.lit(1.0)) / F.lit(2.0) * _weight(p.weight_price_growth, p)
    liq = F.least(
        F.coalesce(tpc, F.lit(0.0)) / F.lit(float(p.high_liquidity_transactions_per_capita)), F.lit(1.0)
    )
    liq_pts = liq * _weight(p.weight_liquidity, p)
    popg = F.least(F.greatest(F.coalesce(pop_cagr, F.lit(0.0)), F.lit(-mp)), F.lit(mp))
    pop_pts = (popg / F.lit(mp) + F.lit(1.0)) / F.lit(2.0) * _weight(p.weight_population_growth, p)
    inc = F.least(F.coalesce(income, F.lit(0.0)) / F.lit(float(p.income_cap)), F.lit(1.0))
    inc_pts = inc * _weight(p.weight_income, p)
    total = price_pts + growth_pts + liq_pts + pop_pts + inc_pts - penalty
    return strict_greatest(F.lit(0.0), total)


def commune_opportunity_score(
    stats: DataFrame,
    indicators: DataFrame,
    cagr: DataFrame,
    pop_cagr: DataFrame,
    tax: DataFrame,
    depts: DataFrame,
    p: Params = DEFAULT,
    rounded: bool = True,
) -> DataFrame:
    """Latest-year rows scored on five factors, thin markets dropped.

    The national median is taken over *all* latest-year rows (both types)
    before the market-size cut; the score only over the rows that pass it.
    """
    latest_year = stats.agg(F.max("year").alias("year"))  # one row
    latest = stats.join(F.broadcast(latest_year), "year")  # bounded: 1 row
    national = agg_with_lower_medians(
        latest, [], {"national_median_price_per_sqm": "median_price_per_sqm"},
        max_exact_group=p.median_max_exact_group, write_sizes=False,  # stats is a written table
        max_rows=known_rows(stats))  # latest-year rows are a subset of stats
    dept_pop = indicators.groupBy("code_departement").agg(F.sum("population").alias("department_population"))

    i = indicators.select(
        F.col("code_insee").alias("code_commune"), "population", "densite", "median_disposable_income"
    )
    c = cagr.select(
        "code_commune", "type_local", "price_cagr",
        F.col("first_year").alias("cagr_first_year"), F.col("last_year").alias("cagr_last_year"),
    )
    pc = pop_cagr.select(
        F.col("code_insee").alias("code_commune"), "population_cagr",
        F.col("first_year").alias("population_cagr_first_year"),
        F.col("last_year").alias("population_cagr_last_year"),
    )
    t = tax.select("code_commune", "taux_foncier_bati", "tax_year")
    d = depts.select("code_departement", "nom_departement")

    j = (
        latest.join(i, "code_commune", "left")
        .join(c, ["code_commune", "type_local"], "left")
        .join(pc, "code_commune", "left")
        .join(t, "code_commune", "left")
        .join(d, "code_departement", "left")
        .join(dept_pop, "code_departement", "left")
    )
    j = (
        attach_one_row(j, national, "left")  # one row by construction, broadcast
        .where(
            (F.col("transaction_count") >= p.min_annual_transaction_count)
            & (F.col("population") >= p.min_commune_population)
        )
    )
    ratio = safe_div(F.col("median_price_per_sqm"), F.col("national_median_price_per_sqm"))
    tpc = safe_div(F.col("transaction_count"), F.col("population"))
    share = safe_div(F.col("population"), F.col("department_population"))
    pen = tax_penalty(F.col("taux_foncier_bati"), p)
    pts = opportunity_points(ratio, F.col("price_cagr"), tpc, F.col("population_cagr"),
                             F.col("median_disposable_income"), pen, p)
    rnd = (lambda x: F.round(x, 1)) if rounded else (lambda x: x)
    return j.select(
        "code_commune",
        "nom_commune",
        "code_departement",
        "nom_departement",
        "type_local",
        "year",
        "transaction_count",
        "median_price_per_sqm",
        "yoy_price_change_pct",
        "price_cagr",
        "cagr_first_year",
        "cagr_last_year",
        "population",
        "densite",
        "median_disposable_income",
        "population_cagr",
        "population_cagr_first_year",
        "population_cagr_last_year",
        "taux_foncier_bati",
        "tax_year",
        "national_median_price_per_sqm",
        ratio.alias("price_vs_national_median_ratio"),
        tpc.alias("transactions_per_capita"),
        share.alias("population_share_of_department"),
        rnd(pen).alias("property_tax_penalty_pts"),
        rnd(pts).alias("opportunity_score"),
    )


def department_opportunity_score(score: DataFrame, p: Params = DEFAULT, score_is_table: bool = False) -> DataFrame:
    """Department rollup of the commune score (lower medians, exact count).

    ``score_is_table``: the score is a written table, cheap to read twice.
    """
    return agg_with_lower_medians(
        score,
        ["code_departement", "nom_departement"],
        {
            "median_opportunity_score": "opportunity_score",
            "median_price_per_sqm": "median_price_per_sqm",
            "median_price_cagr": "price_cagr",
        },
        extra_aggs=[
            F.countDistinct("code_commune").alias("commune_count"),
            F.sum("transaction_count").alias("total_transactions"),
        ],
        max_exact_group=p.median_max_exact_group,
        write_sizes=not score_is_table,
    ).select("code_departement", "nom_departement", "commune_count", "median_opportunity_score",
             "median_price_per_sqm", "median_price_cagr", "total_transactions")


def order_by_score(df: DataFrame, col: str = "opportunity_score", *tiebreak: str) -> DataFrame:
    """Descending score, missing last, key tiebreak."""
    return df.orderBy(F.col(col).desc_nulls_last(), *[F.col(c).asc() for c in tiebreak])


__all__ = [
    "commune_indicators",
    "commune_opportunity_score",
    "commune_year_stats",
    "department_opportunity_score",
    "latest_tax",
    "opportunity_points",
    "order_by_score",
    "period_stats",
    "population_cagr",
    "price_cagr",
    "qualifying_sales",
    "tax_penalty",
]
