import datetime as dt

import pytest
from pyspark.sql import functions as F

from kilowatt.operators import silver
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, 10)
T1 = dt.datetime(2024, 1, 1, 11)

SOLAR_COLS = "event_id long, timestamp timestamp, site_id string, panel_temp_c double, " \
             "irradiance_w_m2 double, production_kwh double, status string, _ingested_at timestamp"
WIND_COLS = "event_id long, timestamp timestamp, site_id string, wind_speed_ms double, " \
            "wind_direction_deg int, production_kwh double, status string"


def solar(spark, data):
    return spark.createDataFrame(data, SOLAR_COLS)


def wind(spark, data):
    return spark.createDataFrame(data, WIND_COLS)


def test_drop_audit(spark):
    df = solar(spark, [(1, T0, "S1", 20.0, 500.0, 10.0, "OK", T0)])
    assert "_ingested_at" not in silver.drop_audit(df).columns
    assert "panel_temp_c" in silver.drop_audit(df).columns


def test_clean_negative_zero_null_and_status(spark):
    df = solar(spark, [
        (1, T0, "S1", 1.0, -5.0, -1.0, "OK", None),       # negatives → NULL
        (2, T0, "S2", 1.0, 0.0, 0.0, None, None),         # zero kept, NULL status → UNKNOWN
        (3, T0, "S3", 1.0, None, None, "MAINT", None),    # unknown status
        (4, T0, "S4", 1.0, 5.0, 2.0, "DEGRADED", None),
    ])
    out = rows(silver.clean_readings(df, ["production_kwh", "irradiance_w_m2"]), "event_id")
    assert [r["production_kwh"] for r in out] == [None, 0.0, None, 2.0]
    assert [r["irradiance_w_m2"] for r in out] == [None, 0.0, None, 5.0]
    assert [r["status"] for r in out] == ["OK", "UNKNOWN", "UNKNOWN", "DEGRADED"]


def test_dedup_keeps_best_nulls_last_and_tiebreak(spark):
    df = solar(spark, [
        (1, T0, "S1", 1.0, 1.0, None, "OK", None),
        (2, T0, "S1", 1.0, 1.0, 3.0, "OK", None),
        (3, T0, "S1", 1.0, 1.0, 5.0, "OK", None),       # best
        (4, T1, "S1", 1.0, 1.0, None, "OK", None),      # all NULL: smallest event_id
        (5, T1, "S1", 1.0, 1.0, None, "OK", None),
        (6, T0, "S2", 1.0, 1.0, 2.0, "OK", None),       # tie on production
        (7, T0, "S2", 1.0, 1.0, 2.0, "OK", None),
        (8, T0, "S3", 1.0, 1.0, 1.0, "OK", None),       # exact duplicate pair
        (8, T0, "S3", 1.0, 1.0, 1.0, "OK", None),
    ])
    out = rows(silver.dedup_keep_best(df, ["timestamp", "site_id"], "production_kwh", ["event_id"]),
               "site_id", "timestamp")
    assert [(r["site_id"], r["event_id"]) for r in out] == [("S1", 3), ("S1", 4), ("S2", 6), ("S3", 8)]


def test_dedup_plan_limits_before_shuffle(spark):
    df = solar(spark, [(1, T0, "S1", 1.0, 1.0, 1.0, "OK", None)])
    plan = silver.dedup_keep_best(df, ["timestamp", "site_id"], tiebreak=["event_id"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_silver_production_union_and_derivations(spark):
    s = solar(spark, [
        (1, T0, "S1", 25.0, 800.0, 40.0, "OK", None),
        (2, T0, "S1", 25.0, 800.0, 30.0, "OK", None),     # duplicate, lower
        (3, T1, "S1", 25.0, 0.0, 10.0, "OFFLINE", None),  # irradiance 0 → no efficiency
        (4, T1, "S2", 25.0, -1.0, -3.0, "X", None),       # both negative → NULL
    ])
    w = wind(spark, [
        (10, T0, "W1", 7.5, 270, 100.0, "OK"),
        (11, T0, "W1", -2.0, 90, 120.0, "DEGRADED"),     # best, negative speed → NULL
    ])
    out = silver.silver_production({"solar": s, "wind": w}, tiebreak=["event_id"])
    assert out.columns == ["timestamp", "site_id", "technology", "production_kwh", "status",
                           "sensor_metric_1", "sensor_metric_2", "date", "hour",
                           "is_production", "efficiency_pct"]
    assert dict(out.dtypes)["sensor_metric_2"] == "double"  # int direction widened
    got = rows(out, "site_id", "timestamp")
    assert len(got) == 4
    s1 = got[0]
    assert s1["production_kwh"] == 40.0 and s1["efficiency_pct"] == 5.0  # 40 / (800 × 0.01)
    assert s1["date"] == dt.date(2024, 1, 1) and s1["hour"] == 10 and s1["is_production"] is True
    assert got[1]["efficiency_pct"] is None
    assert got[2]["production_kwh"] is None and got[2]["is_production"] is None
    assert got[2]["status"] == "UNKNOWN" and got[2]["sensor_metric_2"] is None
    w1 = got[3]
    assert (w1["technology"], w1["production_kwh"], w1["sensor_metric_1"], w1["sensor_metric_2"],
            w1["efficiency_pct"]) == ("wind", 120.0, None, 90.0, None)


def test_efficiency_is_the_double_quotient_rounded(spark):
    s = solar(spark, [(1, T0, "S1", 1.0, 40.0, 57.51, "OK", None)])
    out = rows(silver.silver_production({"solar": s}))
    assert out[0]["efficiency_pct"] == 143.77  # 57.51 / 0.4 is 143.77499999999998 as a double


def test_enrich_sites_missing_zero_null_malformed_capacity(spark):
    prod = spark.createDataFrame(
        [("S1", 500.0), ("S2", 500.0), ("S3", 500.0), ("S4", 500.0), ("S9", 500.0)],
        "site_id string, production_kwh double")
    sites = spark.createDataFrame(
        [("S1", "a", "r", "2.0", "1", "2"), ("S2", "b", "r", "0", "1", "2"),
         ("S3", "c", "r", None, "1", "2"), ("S4", "d", "r", "abc", "x", "2")],
        "site_id string, site_name string, region string, capacity_mw string, latitude string, longitude string")
    out = {r["site_id"]: r for r in rows(silver.enrich_sites(prod, sites))}
    assert out["S1"]["capacity_factor_pct"] == 25.0  # 500 / 2000 × 100
    assert out["S2"]["capacity_factor_pct"] is None
    assert out["S3"]["capacity_factor_pct"] is None
    assert out["S4"]["capacity_mw"] is None and out["S4"]["latitude"] is None
    assert out["S9"]["site_name"] is None  # unmatched fact kept (left join)


def test_enrich_hints_a_broadcast_only_when_asked(spark):
    from kilowatt import fixtures as fx
    from tests.conftest import SF_TINY
    prod, sites = fx.readings(spark, SF_TINY).select("site_id", "production_kwh"), fx.sites(spark, SF_TINY)

    def plan(**options):
        return silver.enrich_sites(prod, sites, **options)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan()
    assert "strategy=broadcast" in plan(broadcast_sites=True)


@pytest.mark.parametrize("irradiance,want", [(0.00003, 3333333.33), (0.00006, 1666666.67), (0.0, None), (-1.0, None), (5e-324, None), (None, None)])
def test_efficiency_on_small_irradiance(spark, irradiance, want):
    from kilowatt.functions.expressions import solar_efficiency_pct
    df = spark.createDataFrame([(1.0, irradiance)], "production_kwh double, irradiance_w_m2 double")
    assert df.select(solar_efficiency_pct()).first()[0] == want


def test_validation_profile_null_when_no_match(spark):
    prod = spark.createDataFrame([("solar", "S1", 1.0, "OK"), ("solar", "S2", 2.0, "OK"),
                                  ("wind", "W1", None, "OFFLINE")],
                                 "technology string, site_id string, production_kwh double, status string")
    out = {r["technology"]: r for r in rows(silver.validation_profile(prod))}
    assert out["solar"]["offline_count"] is None and out["solar"]["null_production_count"] is None
    assert out["solar"]["avg_production_kwh"] == 1.5 and out["solar"]["nb_sites"] == 2
    assert out["wind"]["offline_count"] == 1 and out["wind"]["null_production_count"] == 1


def test_drop_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k int, v string")
    assert silver.drop_exact_duplicates(df).count() == 2
    assert silver.drop_exact_duplicates(df, ["v"]).count() == 1


def test_validation_profile_of_extreme_readings(spark):
    rows = [("solar", 1, v, "OK") for v in (1e16, 2e16, float("nan"), float("inf"), -float("inf"), 1e30, None)] + [("wind", 1, float("nan"), "OK")]
    df = spark.createDataFrame(rows, "technology string, site_id long, production_kwh double, status string")
    out = {r["technology"]: r for r in silver.validation_profile(df).collect()}
    assert (out["solar"]["avg_production_kwh"], out["solar"]["max_production_kwh"], out["solar"]["total_records"]) == (1.5e16, 2e16, 7)
    assert (out["wind"]["avg_production_kwh"], out["wind"]["max_production_kwh"], out["wind"]["null_production_count"]) == (None, None, None)
