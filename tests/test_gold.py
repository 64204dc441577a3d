import datetime as dt

from pyspark.sql import functions as F

from kilowatt.operators import gold
from tests.conftest import rows

D1, D2, D3, D5 = (dt.date(2024, 1, d) for d in (1, 2, 3, 5))
PROD = ("timestamp timestamp, site_id string, technology string, production_kwh double, "
        "status string, date date")


def prod(spark, data):
    return spark.createDataFrame(data, PROD)


def sites(spark):
    return spark.createDataFrame([("S1", "One", "North", "1.0", "0", "0"),
                                  ("S2", "Two", "South", "0", "0", "0")],
                                 "site_id string, site_name string, region string, capacity_mw string, "
                                 "latitude string, longitude string")


def ts(d, h):
    return dt.datetime(d.year, d.month, d.day, h)


def test_daily_kpis_hand_computed(spark):
    p = prod(spark, [
        (ts(D1, 0), "S1", "solar", 100.0, "OK", D1),
        (ts(D1, 1), "S1", "solar", 200.0, "OFFLINE", D1),
        (ts(D1, 2), "S1", "solar", None, "DEGRADED", D1),
        (ts(D1, 3), "S1", "solar", 0.005, "UNKNOWN", D1),
        (ts(D1, 0), "S2", "wind", 10.0, "OK", D1),      # capacity 0 → CF NULL
        (ts(D1, 0), "S3", "wind", 5.0, "OK", D1),       # no site row
    ])
    out = {r["site_id"]: r for r in rows(gold.daily_kpis(p, sites(spark)))}
    s1 = out["S1"]
    assert s1["total_production_kwh"] == 300.01       # 300.005 → HALF_UP
    assert s1["total_production_mwh"] == 0.3
    assert s1["avg_hourly_production_kwh"] == 100.0   # NULL ignored: 300.005 / 3
    assert s1["peak_production_kwh"] == 200.0
    assert (s1["total_hours"], s1["hours_ok"], s1["hours_offline"], s1["hours_degraded"]) == (4, 1, 1, 1)
    assert s1["availability_pct"] == 75.0              # UNKNOWN counts as available
    assert s1["daily_capacity_factor_pct"] == 1.25     # 300.005 / 24000 × 100
    assert out["S2"]["daily_capacity_factor_pct"] is None
    assert out["S3"]["site_name"] is None and out["S3"]["total_hours"] == 1
    assert list(gold.daily_kpis(p, sites(spark)).columns) == gold.DAILY_COLUMNS


def test_daily_kpis_from_enriched_silver_matches_join_form(spark):
    p = prod(spark, [(ts(D1, h), "S1", "solar", float(h), "OK", D1) for h in range(24)])
    enriched = p.join(sites(spark).select("site_id", "site_name", "region",
                                          F.col("capacity_mw").cast("double").alias("capacity_mw")),
                      "site_id", "left")
    a = rows(gold.daily_kpis(p, sites(spark)))
    b = rows(gold.daily_kpis(enriched))
    assert a == b


def daily_rows(spark, data):
    return spark.createDataFrame(data, "date date, site_id string, technology string, "
                                       "total_production_mwh double")


def test_enrich_daily_lag_dod_rolling_rank(spark):
    d = daily_rows(spark, [
        (D1, "S1", "solar", 0.0), (D2, "S1", "solar", 2.0), (D3, "S1", "solar", 3.0),
        (D5, "S1", "solar", 1.0),                           # missing day 4: rows, not days
        (D1, "S2", "solar", 5.0), (D2, "S2", "solar", 2.0), (D3, "S2", "solar", 3.0),
        (D1, "S3", "wind", 1.0),
    ])
    out = {(r["site_id"], r["date"]): r for r in rows(gold.enrich_daily(d))}
    assert out[("S1", D1)]["prev_day_production_mwh"] is None
    assert out[("S1", D2)]["day_over_day_change_pct"] is None      # previous 0 → NULL
    assert out[("S1", D3)]["day_over_day_change_pct"] == 50.0
    assert out[("S1", D5)]["prev_day_production_mwh"] == 3.0        # previous *row*
    assert out[("S1", D5)]["rolling_7d_avg_mwh"] == 1.5            # (0+2+3+1)/4
    assert out[("S2", D2)]["day_over_day_change_pct"] == -60.0
    assert out[("S1", D2)]["daily_rank_in_technology"] == 1           # tie 2.0 / 2.0
    assert out[("S2", D2)]["daily_rank_in_technology"] == 1
    assert out[("S1", D3)]["daily_rank_in_technology"] == 1
    assert out[("S2", D1)]["daily_rank_in_technology"] == 1
    assert out[("S1", D1)]["daily_rank_in_technology"] == 2
    assert out[("S3", D1)]["daily_rank_in_technology"] == 1          # its own technology


def test_rolling_window_is_seven_rows(spark):
    d = daily_rows(spark, [(dt.date(2024, 1, i), "S1", "solar", float(i)) for i in range(1, 11)])
    out = {r["date"].day: r["rolling_7d_avg_mwh"] for r in rows(gold.enrich_daily(d))}
    assert out[7] == 4.0 and out[10] == 7.0 and out[2] == 1.5


def test_next_day_lead(spark):
    d = daily_rows(spark, [(D1, "S1", "solar", 1.0), (D2, "S1", "solar", 2.0)])
    out = rows(gold.next_day(d), "date")
    assert [r["next_day_total_production_mwh"] for r in out] == [2.0, None]


def test_site_efficiency_report(spark):
    d = spark.createDataFrame([
        (D1, "S1", "solar", "One", "North", 1.0, 0.1234, 0, 100.0, 10.0),
        (D2, "S1", "solar", "One", "North", 1.0, 0.2, 3, 87.5, 20.0),
        (dt.date(2024, 2, 1), "S1", "solar", "One", "North", 1.0, 1.0, 0, 100.0, None),
    ], "date date, site_id string, technology string, site_name string, region string, capacity_mw double, "
       "total_production_mwh double, hours_offline long, availability_pct double, "
       "daily_capacity_factor_pct double")
    out = {r["month"]: r for r in rows(gold.site_efficiency_report(d))}
    jan = out[1]
    assert jan["month_label"] == "2024-01" and jan["year"] == 2024
    assert jan["monthly_production_mwh"] == 0.32
    assert jan["avg_capacity_factor_pct"] == 15.0 and jan["avg_availability_pct"] == 93.8
    assert jan["days_with_outage"] == 1 and jan["max_daily_offline_hours"] == 3
    assert jan["performance_score"] == 46.5            # 93.75 × 0.4 + 15 × 0.6
    assert out[2]["performance_score"] is None          # NULL capacity factor → NULL score


def test_top_days_is_limited_and_ordered(spark):
    d = daily_rows(spark, [(D1, f"S{i}", "solar", float(i)) for i in range(30)]
                   + [(D2, "S0", "solar", 0.5)])
    out = gold.top_days(d, 5).collect()
    assert len(out) == 5 and out[0]["date"] == D2 and out[1]["site_id"] == "S29"


def test_enrich_daily_calendar_respects_gaps(spark):
    d = daily_rows(spark, [(D1, "S1", "solar", 1.0), (D2, "S1", "solar", 2.0),
                           (D3, "S1", "solar", 3.0), (D5, "S1", "solar", 5.0),
                           (dt.date(2024, 1, 12), "S1", "solar", 12.0)])
    out = {r["date"].day: r for r in rows(gold.enrich_daily(d, calendar=True))}
    assert out[5]["prev_day_production_mwh"] is None          # day 4 missing
    assert out[3]["prev_day_production_mwh"] == 2.0
    assert out[5]["rolling_7d_avg_mwh"] == 2.75               # days 1,2,3,5
    assert out[12]["rolling_7d_avg_mwh"] == 12.0              # days 6..12: only day 12


def test_multi_scale_rollup_equals_one_rollup_per_unit(spark):
    from kilowatt.operators import timescale
    from kilowatt.plans.queries import raw_readings
    from tests.conftest import SF_TINY
    r = raw_readings(spark, SF_TINY)
    a = timescale.multi_scale_rollup(r)
    cols = sorted(a.columns)
    b = [tuple(x) for u in timescale.UNITS for x in timescale.timescale_rollup(r, u).select(*cols).collect()]
    assert sorted(map(tuple, a.select(*cols).collect())) == sorted(b)


def test_small_readings_are_summed_before_rounding(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(ts, "S1", "solar", 0.00004)] * 1440 + [(ts, "S1", "solar", float("nan"))],
                               "timestamp timestamp, site_id string, technology string, production_kwh double")
    from kilowatt.operators import timescale
    row = timescale.timescale_rollup(df, "day").first()
    assert row["total_kwh"] == 0.0576 and row["n_readings"] == 1441  # NaN: no measurement


def test_lag_follows_the_site_across_technologies(spark):
    d = daily_rows(spark, [(D1, "S1", "solar", 1.0), (D1, "S1", "wind", 2.0), (D2, "S1", "solar", 3.0)])
    out = {(r["date"], r["technology"]): r["prev_day_production_mwh"] for r in rows(gold.enrich_daily(d))}
    assert out == {(D1, "solar"): None, (D1, "wind"): 1.0, (D2, "solar"): 2.0}
