import datetime as dt

import pytest

from kilowatt import constants as K
from kilowatt.operators import anomaly
from tests.conftest import rows


def series(spark, values, site="S1"):
    return spark.createDataFrame(
        [(dt.date(2024, 1, 1) + dt.timedelta(days=i), site, "solar", v) for i, v in enumerate(values)],
        "date date, site_id string, technology string, total_production_mwh double")


@pytest.mark.parametrize("n,max_z", [(4, 1.5), (5, 1.79), (6, 2.04)])
def test_short_history_bounds(spark, n, max_z):
    # the current row is inside its window: |z| <= (n-1)/sqrt(n)
    z = rows(anomaly.with_zscore(series(spark, [1.0] * (n - 1) + [100.0])), "date")
    assert abs(z[-1]["z_score"]) == pytest.approx(max_z, abs=0.01)


def test_bands_and_filter(spark):
    base = [10.0, 10.2, 9.8, 10.1, 9.9] * 6
    cases = {"low": base + [5.0], "high": base + [15.0], "weak": base + [9.72], "mid": base + [10.28]}
    labels = {}
    for k, v in cases.items():
        out = rows(anomaly.detect_anomalies(series(spark, v), limit=None), "date")
        labels[k] = [(r["z_score"], r["alert_level"]) for r in out if r["date"].day == 31]
    assert labels["low"][0][1] == K.ALERT_LOW
    assert labels["high"][0][1] == K.ALERT_HIGH
    assert labels["weak"][0][1] == K.ALERT_WEAK and -2 <= labels["weak"][0][0] < -1.5
    assert labels["mid"][0][1] == K.ALERT_NORMAL and 1.5 < labels["mid"][0][0] <= 2


def test_constant_series_has_null_z_and_no_alert(spark):
    s = series(spark, [3.0] * 10)
    assert all(r["z_score"] is None for r in rows(anomaly.with_zscore(s)))
    assert anomaly.detect_anomalies(s).count() == 0


def test_limit_is_top_abs_z(spark):
    s = series(spark, [10.0, 10.2, 9.8, 10.1, 9.9] * 6 + [5.0, 15.0, 9.0]).unionByName(
        series(spark, [1.0, 1.1, 0.9] * 10 + [0.1], site="S2"))
    out = anomaly.detect_anomalies(s, limit=2).collect()
    full = sorted((abs(r["z_score"]) for r in anomaly.detect_anomalies(s, limit=None).collect()), reverse=True)
    assert [abs(r["z_score"]) for r in out] == full[:2]


def test_one_day_site_has_null_std_and_31st_day_drops_the_first(spark):
    one = anomaly.with_zscore(series(spark, [5.0], site="S1")).collect()[0]
    assert one["rolling_30d_std"] is None and one["z_score"] is None
    vals = [100.0] + [1.0, 2.0] * 15                     # 31 days; day 1 is far off
    got = rows(anomaly.with_zscore(series(spark, vals, site="S2")), "date")
    # means are exact decimals at 8 places
    assert abs(got[29]["rolling_30d_avg"] - sum(vals[:30]) / 30) < 1e-7
    assert abs(got[30]["rolling_30d_avg"] - sum(vals[1:31]) / 30) < 1e-7   # day 1 left the frame
