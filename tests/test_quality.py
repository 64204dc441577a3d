import pytest
from pyspark.sql import functions as F

from kilowatt.operators import quality
from tests.conftest import rows


def df(spark):
    return spark.createDataFrame([(1, "solar", 1.0), (2, "wind", None), (3, "hydro", -1.0), (4, None, 0.0)],
                                 "id int, technology string, production_kwh double")


def test_report_counts(spark):
    out = {r["rule"]: r["violations"] for r in rows(quality.expect(df(spark), quality.silver_rules(), "report"))}
    # NULL technology passes the CHECK (NULL is not FALSE)
    assert out == {"chk_production_positive": 1, "chk_technology_valid": 1}


def test_quarantine_split(spark):
    ok, bad = quality.expect(df(spark), quality.silver_rules(), "quarantine")
    assert sorted(r["id"] for r in ok.collect()) == [1, 2, 4]
    assert [(r["id"], r["failed_rules"]) for r in bad.collect()] == \
        [(3, "chk_production_positive,chk_technology_valid")]


def test_fail_mode(spark):
    with pytest.raises(quality.ExpectationFailed):
        quality.expect(df(spark), quality.silver_rules(), "fail")
    good = df(spark).filter("id IN (1, 2)")
    assert quality.expect(good, quality.silver_rules(), "fail") is good


def test_not_null_rule(spark):
    rules = {"nn_technology": F.col("technology").isNotNull()}
    out = rows(quality.expect(df(spark), rules, "report"))
    assert out == [{"rule": "nn_technology", "violations": 1}]


def test_enforce_fails_in_the_consuming_job(spark):
    good = df(spark).filter("id IN (1, 2)")
    out = quality.expect(good, quality.silver_rules(), "enforce")
    assert sorted(r["id"] for r in out.collect()) == [1, 2]          # passes through unchanged
    bad = quality.expect(df(spark), quality.silver_rules(), "enforce")  # lazy: nothing runs yet
    with pytest.raises(Exception, match="chk_production_positive|chk_technology_valid"):
        bad.count()
