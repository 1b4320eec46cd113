"""Header normalisation for landed files (metadata only, runs on the driver)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# The accented letters folded by the landing step, and their
# plain replacements, in the same order.
ACCENTED = "éèêëàâïîôùûç"
PLAIN = "eeeeaaiiouuc"
_FOLD = str.maketrans(ACCENTED, PLAIN)


def normalize_column_name(name: str) -> str:
    """The runs of letters and digits of a folded header, joined by ``_``.

    A name that starts with a digit gets the prefix ``c``; one without any
    letter or digit is ``col``.
    """
    runs = re.findall("[a-z0-9]+", str(name).lower().translate(_FOLD))
    if not runs:
        return "col"
    return "_".join(["c", *runs] if runs[0][0] in "0123456789" else runs)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column of ``df`` with :func:`normalize_column_name`."""
    return df.toDF(*[normalize_column_name(c) for c in df.columns])
