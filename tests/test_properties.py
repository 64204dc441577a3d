"""Property tests (hypothesis) for the operators whose invariants matter most."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from kilowatt.operators import layout, merge, ranking, silver
from kilowatt.session import scratch_path

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
RANK_SETTINGS = settings(SETTINGS, max_examples=5)  # each example writes its ranges
T0 = dt.datetime(2024, 1, 1)

readings = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4),
                              st.one_of(st.none(), st.integers(-5, 5).map(float))),
                    min_size=1, max_size=40)


@SETTINGS
@given(readings)
def test_dedup_unique_keys_and_keeps_max(spark, data):
    rows = [(i, T0 + dt.timedelta(hours=h), f"S{s}", v) for i, (s, h, v) in enumerate(data)]
    df = spark.createDataFrame(rows, "event_id long, timestamp timestamp, site_id string, production_kwh double")
    out = silver.dedup_keep_best(df, ["timestamp", "site_id"], tiebreak=["event_id"]).collect()
    keys = [(r["timestamp"], r["site_id"]) for r in out]
    assert len(keys) == len(set(keys)) == len({(r[1], r[2]) for r in rows})
    best = {}
    for _, t, s, v in rows:
        k = (t, s)
        if v is not None and (best.get(k) is None or v > best[k]):
            best[k] = v
        best.setdefault(k, None)
    assert {(r["timestamp"], r["site_id"]): r["production_kwh"] for r in out} == best


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 3)), max_size=25),
       st.lists(st.tuples(st.integers(0, 20), st.integers(0, 3)), max_size=25))
def test_merge_idempotent(spark, tgt, src):
    d = dt.date(2024, 1, 28)
    t = spark.createDataFrame([(k, float(v), d) for k, v in dict(tgt).items()] or [(None, None, d)],
                              "k long, v double, date date").filter("k IS NOT NULL")
    s = spark.createDataFrame([(k, float(v), d) for k, v in dict(src).items()] or [(None, None, d)],
                              "k long, v double, date date").filter("k IS NOT NULL")
    once = merge.merge_upsert(t, s, ["k"], ["v"], dt.date(2024, 1, 30)).drop("_action")
    twice = merge.merge_upsert(once, s, ["k"], ["v"], dt.date(2024, 1, 30)).drop("_action")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    # every source row is in the result, unchanged
    res = {r["k"]: r["v"] for r in once.collect()}
    assert all(res[k] == float(v) for k, v in dict(src).items())


@RANK_SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 12)), min_size=1, max_size=60),
       st.integers(1, 6), st.booleans())
def test_global_rank_matches_window(spark, values, buckets, descending):
    df = spark.createDataFrame(list(enumerate(values)), "id long, value long")
    o = F.col("value").desc() if descending else F.col("value").asc()
    want = df.withColumns({"dense_rank": F.dense_rank().over(Window.orderBy(o)).cast("bigint"),
                           "rank": F.rank().over(Window.orderBy(o)).cast("bigint"),
                           "row_number": F.row_number().over(Window.orderBy(o, "id")).cast("bigint")})
    got = ranking.global_rank(df, "value", descending, ["id"], ranges=buckets)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


@SETTINGS
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(0, 9), st.text(max_size=3)), min_size=1,
                max_size=50))
def test_zorder_keeps_multiset(spark, data):
    df = spark.createDataFrame(data, "a int, b int, c string")
    p = layout.zorder_layout(df, ["a", "c"], scratch_path(spark, "t-prop-z"), files=3)
    assert sorted(map(tuple, spark.read.parquet(p).select("a", "b", "c").collect())) == sorted(data)


@RANK_SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot"]),
                          st.one_of(st.none(), st.integers(0, 6))), min_size=1, max_size=80),
       st.integers(2, 6), st.booleans())
def test_bucketed_rank_matches_partitioned_window(spark, data, buckets, descending):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id long, g string, value long")
    want = ranking.rank_within(df, ["g"], "value", descending, ["id"])
    got = ranking.bucketed_rank(df, ["g"], "value", descending, ["id"], ranges=buckets)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
