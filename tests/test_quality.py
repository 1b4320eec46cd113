import pytest

from cadastra.operators import quality
from cadastra.operators.quality import Check


def test_checks_find_nulls_duplicates_orphans(spark):
    t = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, v int")
    dim = spark.createDataFrame([("a",)], "k string")
    checks = [Check("t", "not_null", ("k",)), Check("t", "unique", ("k",)),
              Check("t", "unique_combination", ("k", "v")), Check("t", "relationship", ("k",), "dim", "k")]
    out = {r["check"]: (r["failing_rows"], r["passed"]) for r in quality.run_checks({"t": t, "dim": dim}, checks).collect()}
    assert out["not_null:t.k"] == (1, False)
    assert out["unique:t.k"] == (2, False)           # nulls ignored, both 'a' rows fail
    assert out["unique_combination:t.k+v"] == (0, True)
    assert out["relationship:t.k->dim.k"] == (1, False)  # 'b' is an orphan, null is not


def test_coverage_audit_and_all_missing(spark):
    deps = spark.createDataFrame([("01",), ("2A",)], "code_departement string")
    landed = spark.createDataFrame([("01", 2022), ("01", 2022)], "source_departement string, source_year int")
    exp = quality.expected_partitions(deps, 2022, 2023)
    audit = {(r["code_departement"], r["year"]): r for r in quality.coverage_audit(exp, landed).collect()}
    assert len(audit) == 4
    assert audit[("01", 2022)]["rows_landed"] == 2 and audit[("01", 2022)]["landed"]
    assert not audit[("2A", 2023)]["landed"]
    quality.assert_some_landed(quality.coverage_audit(exp, landed))
    with pytest.raises(RuntimeError):
        quality.assert_some_landed(quality.coverage_audit(exp, landed.where("false")))


def test_report_reads_deduped_sales_and_bars_once_written(spark):
    from cadastra.plans import registry

    report = registry.QUERIES["quality_report"](spark, "/root/testdata/sf0.001")
    assert not [f for f in report.inputFiles() if "lineitem" in f or "events" in f]
