from statistics import median

from cadastra.operators import histograms


def test_filters_merge_to_exact_medians(spark):
    rows = [("01" if i % 3 else None, f"c{i // 2}", "A" if i % 2 else "R", (i * 37 % 100) / 10 if i % 5 else None,
             float(i // 2 * 11 % 17), i // 2, "Ain") for i in range(60)]
    score = spark.createDataFrame(
        rows, "code_departement string, code_commune string, type_local string, opportunity_score double,"
              " median_disposable_income double, population long, nom_departement string")
    h = histograms.build(score)
    for types in (("A",), ("A", "R"), ("x",)):
        got = {r["code_departement"]: (r["median_score"], r["commune_count"]) for r in histograms.department_medians(h, types=types).collect()}
        want = {}
        for d in ("01", None):
            sub = [r for r in rows if r[0] == d and r[2] in types]
            if sub:
                want[d] = (median(r[3] for r in sub if r[3] is not None), len({r[1] for r in sub}))
        assert got == want
    one = histograms.department_medians(h, department="01").collect()
    assert len(one) == 1 and one[0]["nom_departement"] == "Ain"
    empty = histograms.build(score.limit(0))
    assert histograms.department_medians(empty).count() == 0
    assert histograms.national_medians(empty).first()["national_median_income"] is None
