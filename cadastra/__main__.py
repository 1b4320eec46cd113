"""Build and export the marts from a test-data folder.

usage: python -m cadastra <sf_dir> <out_dir> [--landed] [--master local[8]]

With ``--landed`` the folder is not a test-data folder but a landing store:
``<sf_dir>/raw`` (see ``sources/store.py``) and ``<sf_dir>/seeds``.

On a cluster, submit with spark-submit: the existing session (and its
``spark.checkpoint.dir``) is used as is.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cadastra.plans import marts
from cadastra.plans.inputs import Inputs
from cadastra.plans.landed import LandedInputs
from cadastra.session import ensure_checkpoint_dir


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("sf_dir")
    ap.add_argument("out_dir")
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    ap.add_argument("--landed", action="store_true", help="sf_dir holds raw tables and seeds")
    args = ap.parse_args()
    b = SparkSession.builder.appName("cadastra-marts").config("spark.ui.enabled", "false")
    if args.master:
        b = b.master(args.master)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    inputs = LandedInputs(spark, args.sf_dir) if args.landed else Inputs(spark, args.sf_dir)
    built = marts.build(inputs, args.out_dir)
    for r in marts.export(built, args.out_dir, inputs.p).collect():
        print(f"{r['mart']}: {r['row_count']} rows")


if __name__ == "__main__":
    main()
