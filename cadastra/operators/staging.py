"""Staging: typed, deduped views of each raw landing table.

Filters follow the reference order exactly: dedupe first, then null checks on
the *raw* column (an unparseable price survives as null); casts drop no row,
so those of the sales are done before the dedupe.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.operators.dedupe import latest_wins


def default_version_order() -> tuple[Column, ...]:
    """Newest load first. Add a full tiebreak when loads can share a timestamp."""
    return (F.col("_ingested_at").desc(),)


SALE_KEY = ("id_mutation", "id_parcelle", "numero_disposition")
BAR_KEY = ("ticker", "date")


# what the warehouse accepts as text of each type; Spark's own casts take more ('2024' as a date, '1.5d' as a number)
_TEXT_OF = {
    "date": r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$",
    "double": r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$",
    "bigint": r"^\s*[+-]?\d+\s*$",
}


def strict_cast(raw: DataFrame, name: str, to: str) -> Column:
    """Cast of a column; null where a text is not a plain ``to``. Typed columns are cast as they are."""
    c = F.col(name)
    if raw.schema[name].dataType.typeName() == "string":
        c = F.when(c.rlike(_TEXT_OF[to]), c)
    return c.try_cast(to)


def _caster(raw: DataFrame):
    return lambda name, to, alias=None: strict_cast(raw, name, to).alias(alias or name)


_SALE_TYPES = {
    "date_mutation": "date", "valeur_fonciere": "double", "surface_reelle_bati": "double",
    "nombre_pieces_principales": "bigint", "surface_terrain": "double", "longitude": "double", "latitude": "double",
}


_SALE_FILTERED = ("valeur_fonciere", "surface_reelle_bati")  # asked by one filter after the other


def _typed_sales(raw: DataFrame, once: bool = False) -> DataFrame:
    """Sales with typed columns, and whether there is a raw price.

    Filters above are moved below a plain column, and every place that names
    it then casts the text again. ``once``: what filters ask for is cast in a
    generator of one row, which they stay above of. Not needed below a window.
    """
    typed = {c: strict_cast(raw, c, to) for c, to in _SALE_TYPES.items()}
    priced = F.col("valeur_fonciere").isNotNull()
    if not once:
        return raw.withColumns({**typed, "_priced": priced})
    cast = F.struct(*[typed.pop(c).alias(c) for c in _SALE_FILTERED], priced.alias("_priced"))
    kept = [typed[c].alias(c) if c in typed else c for c in raw.columns if c not in _SALE_FILTERED]
    return raw.select(*kept, F.inline(F.array(cast)))


def stg_transactions(raw: DataFrame, order: Sequence[Column] | None = None, keys: Sequence[str] = SALE_KEY,
                     as_raw: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Newest version of each disposition line, priced, with a surface > 0.

    What the dedupe shuffles is kept narrow. Raw text is cast before it; whether
    a sale has a price is still asked of the raw text of its newest version, and
    ``order`` sees the typed columns. Rows that are not raw text yet are ranked
    as they come, by their own ``keys`` and ``order``, and only the newest are
    turned into raw columns by ``as_raw``.
    """
    d = latest_wins(raw if as_raw else _typed_sales(raw), keys, order or default_version_order())
    d = _typed_sales(as_raw(d), once=True) if as_raw else d
    return d.where(F.col("_priced") & (F.col("surface_reelle_bati") > 0)).select(
        "id_mutation",
        "date_mutation",
        "nature_mutation",
        "valeur_fonciere",
        "code_commune",
        "nom_commune",
        "code_departement",
        "id_parcelle",
        "type_local",
        "surface_reelle_bati",
        "nombre_pieces_principales",
        "surface_terrain",
        "longitude",
        "latitude",
        "source_year",
        "source_departement",
    )


def stg_prices(raw: DataFrame, order: Sequence[Column] | None = None, keys: Sequence[str] = BAR_KEY,
               as_raw: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Newest bar per (ticker, date); a bar whose newest version has
    no price disappears (dedupe first, null filter second). Rows that are not
    raw bars yet are ranked as they come, as in :func:`stg_transactions`."""
    d = latest_wins(raw, keys, order or default_version_order())
    d = as_raw(d) if as_raw else d
    _cast = _caster(d)
    is_nan = F.coalesce(F.isnan(strict_cast(d, "adj_close", "double")), F.lit(False))
    d = d.where(F.col("adj_close").isNotNull() & ~is_nan)  # NaN is a missing price
    return d.select(
        "ticker",
        _cast("date", "date"),
        _cast("open", "double"),
        _cast("high", "double"),
        _cast("low", "double"),
        _cast("close", "double"),
        _cast("adj_close", "double"),
        _cast("volume", "bigint"),
        _cast("dividends", "double"),
        _cast("stock_splits", "double"),
    )


def stg_population(raw: DataFrame) -> DataFrame:
    """Population, area and density per commune."""
    _cast = _caster(raw)
    return raw.where(F.col("code_insee").isNotNull()).select(
        "code_insee",
        _cast("population", "bigint"),
        _cast("superficie_km2", "double"),
        _cast("densite", "double"),
        F.col("dep_code").alias("code_departement"),
        F.col("reg_code").alias("code_region"),
    )


def stg_income(raw: DataFrame) -> DataFrame:
    """Median disposable income per commune."""
    _cast = _caster(raw)
    return raw.where(F.col("code_geographique").isNotNull()).select(
        F.col("code_geographique").alias("code_insee"),
        F.col("libelle_geographique").alias("nom_commune"),
        _cast("disp_mediane", "double", "median_disposable_income"),
    )


def stg_population_history(raw: DataFrame) -> DataFrame:
    """Population per commune and census year."""
    _cast = _caster(raw)
    return raw.where(F.col("codgeo").isNotNull()).select(
        F.col("codgeo").alias("code_insee"),
        F.col("libgeo").alias("nom_commune"),
        F.col("coddep").alias("code_departement"),
        _cast("annee_rp", "bigint", "year"),
        _cast("pmun", "bigint", "population"),
    )


def stg_property_tax(raw: DataFrame) -> DataFrame:
    """Built-land tax rate (percentage points) per commune and year."""
    _cast = _caster(raw)
    return raw.where(F.col("insee_com").isNotNull()).select(
        F.col("insee_com").alias("code_commune"),
        F.col("libcom").alias("nom_commune"),
        _cast("exercice", "bigint", "year"),
        _cast("taux_global_tfb", "double", "taux_foncier_bati"),
    )
