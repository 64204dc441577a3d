import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kilowatt.operators import anomaly, gold, incremental
from tests.conftest import shuffle_records

SCHEMA = ("date date, site_id long, technology string, site_name string, region string, capacity_mw double, total_production_kwh double, "
          "total_production_mwh double, avg_hourly_production_kwh double, peak_production_kwh double, total_hours long, hours_ok long, "
          "hours_offline long, hours_degraded long, availability_pct double, daily_capacity_factor_pct double")


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def row(n, site, tech, mwh, offline, avail, cf):
    return (day(n), site, tech, f"site {site}", "r", float(site), None, mwh, None, None, 24, 20, offline, 0, avail, cf)


def states(seed, touched, sites=7, days=70):
    """Daily rows before and after a change on the ``touched`` days, with gaps, hybrid sites and NULLs."""
    rng = random.Random(seed)
    some = lambda n, s, t: row(n, s, t, rng.choice([None, round(rng.uniform(0, 90), 4)]) if rng.random() < 0.2 else round(rng.uniform(0, 90), 4),
                               rng.randrange(5), rng.choice([None, round(rng.uniform(0, 100), 2)]), rng.choice([None, round(rng.uniform(0, 40), 2)]))
    keys = [(n, s, t) for s in range(sites) for n in [*range(days), None] for t in (["solar", "wind"] if s % 3 == 0 else ["wind"]) if rng.random() < 0.7]
    before = {k: some(*k) for k in keys}
    after = dict(before)
    for n in touched:
        for s in range(sites):
            for t in ("solar", "wind"):
                k, what = (n, s, t), rng.random()
                if what < 0.3:
                    after.pop(k, None)
                elif what < 0.6:
                    after[k] = some(*k)
    return list(before.values()), list(after.values())


def both(spark, seed, touched):
    before, after = (spark.createDataFrame(r, SCHEMA) for r in states(seed, touched))
    on = F.coalesce(F.col("date").isin([day(n) for n in touched if n is not None]), F.lit(None in touched))
    return before, after, incremental.changed_days(before.filter(on), after.filter(on)), on


def snap(df):
    return sorted((str(sorted(r.asDict().items())) for r in df.collect()))


@pytest.mark.parametrize("touched", [(10,), (0, 1, 69), (5, 40, None), (3, 4, 5, 6, 30, 31)])
def test_enriched_equals_the_rebuild(spark, touched):
    before, after, changed, _ = both(spark, len(touched), touched)
    got = incremental.enriched_incremental(gold.enrich_daily(before), after, changed, [day(n) for n in touched])
    assert snap(got) == snap(gold.enrich_daily(after))


@pytest.mark.parametrize("touched", [(10,), (0, 35, None)])
def test_zscores_equal_the_rebuild(spark, touched):
    before, after, changed, _ = both(spark, 7, touched)
    new = {(r["date"], r["site_id"], r["technology"]): r for r in incremental.zscore_changes(after, changed).collect()}
    old = {(r["date"], r["site_id"], r["technology"]): r for r in anomaly.with_zscore(before).collect()}
    for r in anomaly.with_zscore(after).collect():
        key = (r["date"], r["site_id"], r["technology"])
        kept = new.get(key) or old[key]
        assert [kept[c] for c in incremental.SCORED] == [r[c] for c in incremental.SCORED], key
    assert len(new) < after.count()


@pytest.mark.parametrize("touched", [(10,), (0, 29, 30, 31, 69, None)])
def test_report_equals_the_rebuild(spark, touched):
    before, after, _, on = both(spark, 3, touched)
    state = incremental.report_state(before)
    now = incremental.merged_state(state, incremental.changed_state(before.filter(on), after.filter(on)))
    assert snap(incremental.report_from_state(now)) == snap(gold.site_efficiency_report(after))
    assert snap(now) == snap(incremental.report_state(after))


def test_the_maximum_goes_down_when_its_day_goes(spark):
    rows = [row(1, 1, "wind", 1.0, 5, 1.0, 1.0), row(2, 1, "wind", 1.0, 2, 1.0, 1.0)]
    state = incremental.report_state(spark.createDataFrame(rows, SCHEMA))
    gone = incremental.changed_state(spark.createDataFrame(rows[:1], SCHEMA), spark.createDataFrame([], SCHEMA))
    assert incremental.report_from_state(incremental.merged_state(state, gone)).first()["max_daily_offline_hours"] == 2
    all_gone = incremental.changed_state(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], SCHEMA))
    assert incremental.report_from_state(incremental.merged_state(state, all_gone)).count() == 0


def test_nothing_changed(spark):
    before, after, changed, _ = both(spark, 4, ())
    assert changed.count() == 0
    assert snap(incremental.enriched_incremental(gold.enrich_daily(before), after, changed, [])) == snap(gold.enrich_daily(after))


def test_what_is_shuffled_is_in_proportion_to_the_change(spark):
    """400 sites of 100 days each, one site changes on one day: the spans are a few rows."""
    days = spark.range(40_000).select((F.col("id") % 400).alias("site_id"), F.expr("date_add(date'2024-01-01', int(id div 400))").alias("date"),
                                      F.lit("wind").alias("technology"), (F.col("id") % 97).cast("double").alias("total_production_mwh"))
    changed = spark.createDataFrame([(7, dt.date(2024, 2, 1))], "site_id long, date date")
    spans = incremental.affected_spans(days, F.broadcast(changed), 6)
    assert spans.count() == 13
    spans = incremental.affected_spans(days, F.broadcast(changed), 6)
    spans.collect()
    assert sum(shuffle_records(spans)) <= 12 * 8 * 2  # at most six rows a task and side
