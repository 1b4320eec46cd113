import json
import os

from cadastra.plans import marts
from cadastra.plans.inputs import Inputs


def test_build_and_export(spark, tmp_path):
    inp = Inputs(spark, "/root/testdata/sf0.001")
    built = marts.build(inp, str(tmp_path))
    meta = {r["mart"]: r["row_count"] for r in marts.export(built, str(tmp_path), inp.p).collect()}
    assert meta["commune_opportunity_score"] == built["commune_opportunity_score"].count() > 0
    assert meta["department_opportunity_score"] > 0
    # exported JSON keeps null fields and renders dates as ISO strings
    rows = spark.read.json(os.path.join(tmp_path, "json", "equity_performance_summary")).collect()
    assert len(rows) == meta["equity_performance_summary"]
    assert "relative_performance_vs_benchmark" in rows[0].asDict()
    assert len(rows[0]["first_date"]) == 10
    base = os.path.join(tmp_path, "json", "wealth_assumptions")
    doc = json.loads(spark.read.text(os.path.join(base, "header")).first()[0])
    blend = doc["equities"]["blended_default"]
    assert blend["method"].startswith("equal-weighted mean across")
    assert doc["alternatives"]["blended_default"]["method"].startswith("fallback")  # short bars: gated
    assert isinstance(doc["real_estate"]["national_median_price_cagr_is_fallback"], bool)
    assert -0.2 <= doc["growth"]["pea_growth_rate"] <= 0.2
    pea = spark.read.json(os.path.join(base, "equities_pea_eligible"))
    eligible = built["equity_performance_summary"].where("pea_eligible").count()
    assert pea.count() == eligible
    depts = spark.read.json(os.path.join(base, "real_estate_by_department")).collect()
    assert len(depts) == built["department_opportunity_score"].where("median_price_cagr is not null").count()
