"""Column-expression helpers: null-safe arithmetic, clamps, header names."""

from cadastra.functions.safe import (
    clamp,
    clamp_or_fallback,
    finite_or_null,
    nan_to_null,
    safe_div,
    safe_pow,
    strict_greatest,
    strict_least,
)
from cadastra.functions.names import normalize_column_name, normalize_columns

__all__ = [
    "clamp",
    "clamp_or_fallback",
    "finite_or_null",
    "nan_to_null",
    "normalize_column_name",
    "normalize_columns",
    "safe_div",
    "safe_pow",
    "strict_greatest",
    "strict_least",
]
