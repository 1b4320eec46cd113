"""Declarative data-quality checks (Q01-Q05, J12) and the coverage audit.

All checks of all tables are one aggregation over marks that the rows leave;
``run_checks`` gives one row per check (name, failing rows, passed).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    table: str
    kind: str  # not_null | unique | unique_combination | relationship
    columns: tuple[str, ...]
    ref_table: str | None = None
    ref_column: str | None = None

    @property
    def name(self) -> str:
        tail = f"->{self.ref_table}.{self.ref_column}" if self.kind == "relationship" else ""
        return f"{self.kind}:{self.table}.{'+'.join(self.columns)}{tail}"


def _marks(table: str, checks: Sequence[Check]) -> list:
    """What a row of ``table`` adds to each check: (number of the check, key, rows that fail or must be unique, rows referred to)."""
    def mark(i: int, key, n, ref=0, when=F.lit(True)):
        keys = key.cast("array<string>")
        return F.when(when, F.struct(F.lit(i).alias("_i"), keys.alias("key"), F.lit(n).alias("n"), F.lit(ref).alias("ref")))

    out = []
    for i, c in enumerate(checks):
        first = F.col(f"`{c.columns[0]}`")
        key = F.array(*[F.col(f"`{x}`").cast("string") for x in c.columns])
        if c.table == table:
            if c.kind == "not_null":
                out.append(mark(i, F.array(), 1, when=first.isNull()))
            elif c.kind in ("unique", "unique_combination"):
                out.append(mark(i, key, 1, when=first.isNotNull() if c.kind == "unique" else F.lit(True)))
            elif c.kind == "relationship":
                out.append(mark(i, key, 1, when=first.isNotNull()))
            else:
                raise ValueError(f"unknown check kind {c.kind}")
        if c.ref_table == table:
            ref = F.col(f"`{c.ref_column}`")
            out.append(mark(i, F.array(ref.cast("string")), 0, 1, when=ref.isNotNull()))
    return out


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Q05: one row per check: check, failing_rows, passed.

    Every table is read once: a row yields a mark for each check it takes part
    in, a key for unique and relationship checks, and a mark without key for a
    null. Marks of all checks are summed by (check, key) in one shuffle, after
    map-side sums, and nothing of a table is written or kept.
    """
    marks = None
    for name, df in tables.items():
        of_row = _marks(name, checks)
        if of_row:
            m = df.select(F.explode(F.array_compact(F.array(*of_row))).alias("_m")).select("_m.*")
            marks = m if marks is None else marks.unionByName(m)
    spark = next(iter(tables.values())).sparkSession
    unique = [i for i, c in enumerate(checks) if c.kind in ("unique", "unique_combination")]
    per_key = marks.groupBy("_i", "key").agg(F.sum("n").alias("n"), F.sum("ref").alias("ref"))
    fails = F.when(F.col("_i").isin(unique), F.col("n") > 1).otherwise(F.col("ref") == 0)
    failing = per_key.groupBy("_i").agg(F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("failing_rows"))
    names = spark.createDataFrame([(i, c.name) for i, c in enumerate(checks)], "_i int, check string")  # a row per declared check
    out = names.join(failing, "_i", "left").select("check", F.coalesce("failing_rows", F.lit(0)).cast("bigint").alias("failing_rows"))
    return out.withColumn("passed", F.col("failing_rows") == 0)


def expected_partitions(departments: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Every (department, year) that should have landed.

    Each department row is expanded by the year range (a fixed, small
    sequence), so no join is needed.
    """
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    return departments.select("code_departement", F.explode(years).alias("year"))


def coverage_audit(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected pairs with their landed row count (0 when missing).

    ``landed`` has one row per sale with source_departement / source_year;
    it is aggregated map-side before meeting the small expected table.
    """
    counts = landed.groupBy(
        F.col("source_departement").alias("code_departement"), F.col("source_year").alias("year")
    ).agg(F.count(F.lit(1)).alias("rows_landed"))
    j = expected.join(counts, ["code_departement", "year"], "left")
    return j.select(
        "code_departement",
        "year",
        F.coalesce(F.col("rows_landed"), F.lit(0)).cast("bigint").alias("rows_landed"),
        F.col("rows_landed").isNotNull().alias("landed"),
    )


def assert_some_landed(audit: DataFrame) -> None:
    """Raise only when *every* expected pair is missing."""
    if audit.where(F.col("landed")).limit(1).count() == 0:
        raise RuntimeError("no expected (department, year) file landed")
