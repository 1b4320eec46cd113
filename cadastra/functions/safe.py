"""Null-propagating scalar helpers, all built from Spark built-ins.

They stay inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def finite_or_null(x) -> Column:
    """NaN and +/-Infinity become null (a SAFE result in warehouse terms)."""
    x = _c(x)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def nan_to_null(x) -> Column:
    """NaN is a value in Spark, not a missing marker; turn it into null."""
    x = _c(x)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 or either side is null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def safe_pow(base, exponent) -> Column:
    """base ** exponent with a null instead of NaN/Infinity (e.g. negative base)."""
    return finite_or_null(F.pow(_c(base).cast("double"), _c(exponent).cast("double")))


def strict_least(*cols) -> Column:
    """least() that is null when any input is null (warehouse semantics).

    Spark's ``least`` skips nulls, so guard it explicitly.
    """
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.least(*cs))


def strict_greatest(*cols) -> Column:
    """greatest() that is null when any input is null."""
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.greatest(*cs))


def clamp(x, lo, hi) -> Column:
    """min(hi, max(lo, x)), null if x is null."""
    return strict_least(strict_greatest(_c(x), _c(lo)), _c(hi))


def clamp_or_fallback(x, limit: float, fallback: float) -> Column:
    """Clamp to +/-limit; a missing or non-finite value takes the fallback."""
    x = _c(x).cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(float(fallback))).otherwise(
        F.greatest(F.lit(-float(limit)), F.least(F.lit(float(limit)), x))
    )
