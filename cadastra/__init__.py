"""cadastra: place and asset research marts as Spark DataFrame functions.

Every public function takes and returns DataFrames (plus a ``Params``), so
stages chain with ``DataFrame.transform`` and Catalyst sees one plan.
"""

from cadastra.params import Params

__all__ = ["Params"]
