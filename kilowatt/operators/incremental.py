"""Gold after a change, in proportion to what changed.

Windows over rows (the day before, the last 7, the last 30) reach from a changed
row to the rows that follow it within its site, no further. So after a merge,
:func:`affected_spans` picks those rows and the ones they look back on, the same
window operators run over these spans alone, and all other rows stay as they
are. Monthly figures are sums, counts and a maximum; :func:`report_state` keeps
them as rows that can be added and taken away again, the maximum as the number
of days of each value, so a month is refreshed from the days that changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowatt.functions.expressions import DEFAULT_SCALE, exact, round_double
from kilowatt.operators.anomaly import with_zscore
from kilowatt.operators.gold import DAILY_KEYS, REPORT_KEYS, enrich_daily

ENRICHED = ("prev_day_production_mwh", "day_over_day_change_pct", "rolling_7d_avg_mwh")
SCORED = ("rolling_30d_avg", "rolling_30d_std", "z_score")
_ORDER = ("date", "technology")


def _same(a: str, b: str, cols: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def changed_days(before: DataFrame, after: DataFrame, site_keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Site and date of the rows that differ between two states of the same days:
    inserted, updated (either state) and deleted ones, each once."""
    cols = before.columns
    diff = before.exceptAll(after.select(*cols)).unionByName(after.select(*cols).exceptAll(before))
    return diff.select(*site_keys, "date").distinct()


def affected_spans(daily: DataFrame, changed: DataFrame, reach: int, site_keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """The rows of ``daily`` (its new state) that windows of ``reach`` rows before
    the current one must see again: per changed site and day (``_of``) the rows of
    that day, the ``reach`` rows after it (both ``_affected``) and the ``reach``
    rows before it. A day that lost its rows affects those after it as well.

    ``changed`` meets the site's rows in a join; what is kept of them is cut to
    ``reach`` rows on the map side before it is shuffled. A changed row without a
    date comes before all dates, as it does in the windows' order."""
    rows, marks = daily.alias("r"), changed.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(site_keys)], F.col("date").alias("_of")).alias("c")
    on = reduce(lambda x, y: x & y, [F.col(f"r.{c}").eqNullSafe(F.col(f"c._k{i}")) for i, c in enumerate(site_keys)])
    met = rows.join(marks, on).select("r.*", "c._of")
    # nulls first, as ascending windows have them
    side = (F.when(F.col("date").eqNullSafe(F.col("_of")), 0)
            .when(F.col("date").isNull() | (F.col("date") < F.col("_of")), -1).otherwise(1))
    met = met.withColumn("_side", side)
    keys = [*site_keys, "_of"]
    up = [F.col(c).asc() for c in _ORDER]
    down = [F.col(c).desc() for c in _ORDER]

    def nearest(which: int, order: list[Column]) -> DataFrame:
        n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return met.filter(F.col("_side") == which).withColumn("_n", n).filter(F.col("_n") <= reach).drop("_n")

    out = met.filter("_side = 0").unionByName(nearest(1, up)).unionByName(nearest(-1, down))
    return out.withColumn("_affected", F.col("_side") >= 0).drop("_side")


def _recomputed(spans: DataFrame, columns: Sequence[str], add, site_keys: Sequence[str]) -> DataFrame:
    """``add`` (a window operator) over each span; its ``columns`` for the affected
    rows, each row once: spans that overlap agree on it."""
    keys = [*site_keys, *[c for c in DAILY_KEYS if c not in site_keys]]
    return add(spans, [*site_keys, "_of"]).filter("_affected").select(*keys, *columns).dropDuplicates(list(keys))


def enriched_changes(daily: DataFrame, changed: DataFrame, site_keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Lag, day-over-day change and 7-row mean of the rows that ``changed`` reaches."""
    spans = affected_spans(daily, changed, 6, site_keys)
    return _recomputed(spans, ENRICHED, lambda df, keys: enrich_daily(df, keys).drop("daily_rank_in_technology"), site_keys)


def zscore_changes(daily: DataFrame, changed: DataFrame, site_keys: Sequence[str] = ("site_id",), rows: int = 30) -> DataFrame:
    """Moving mean, deviation and z-score of the rows that ``changed`` reaches."""
    spans = affected_spans(daily, changed, rows - 1, site_keys)
    return _recomputed(spans, SCORED, lambda df, keys: with_zscore(df, rows=rows, site_keys=keys), site_keys)


def refreshed_enriched(enriched: DataFrame, daily: DataFrame, changed: DataFrame, dates: Sequence) -> tuple[DataFrame, DataFrame]:
    """``(rows, days)``: the enriched rows of every day that the change reaches, and
    these days. ``enriched`` is the table before, ``daily`` the daily table after,
    ``dates`` the days whose rows may have changed, ``changed`` what did.

    Windows are recomputed over the affected spans, the daily rank over the
    changed days; everything else comes from the table before."""
    new = enriched_changes(daily, changed)
    days = new.select("date").unionByName(changed.select("date")).distinct()
    on_days = lambda df: df.join(days.withColumnRenamed("date", "_day"), F.col("date").eqNullSafe(F.col("_day")), "left_semi")
    rows = on_days(daily).alias("d")
    old = on_days(enriched.select(*DAILY_KEYS, *ENRICHED, "daily_rank_in_technology")).alias("o")
    hit = F.coalesce(F.col("date").isin([d for d in dates if d is not None]), F.lit(None in dates))
    ranks = daily.filter(hit).select(*DAILY_KEYS, F.dense_rank().over(
        Window.partitionBy("date", "technology").orderBy(F.col("total_production_mwh").desc())).alias("rank")).alias("k")
    joined = rows.join(new.withColumn("_new", F.lit(True)).alias("n"), _same("d", "n", DAILY_KEYS), "left").join(
        old, _same("d", "o", DAILY_KEYS), "left").join(ranks, _same("d", "k", DAILY_KEYS), "left")
    windows = [F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in ENRICHED]
    rank = F.coalesce(F.col("k.rank"), F.col("o.daily_rank_in_technology")).alias("daily_rank_in_technology")
    return joined.select("d.*", *windows, rank), days


def enriched_incremental(enriched: DataFrame, daily: DataFrame, changed: DataFrame, dates: Sequence) -> DataFrame:
    """The whole enriched table after the change; rows of days that it doesn't
    reach pass through."""
    rows, days = refreshed_enriched(enriched, daily, changed, dates)
    rest = enriched.join(days.withColumnRenamed("date", "_day"), F.col("date").eqNullSafe(F.col("_day")), "left_anti")
    return rest.unionByName(rows.select(*enriched.columns))


# -- monthly report -----------------------------------------------------------

_SUMS = {"mwh": "total_production_mwh", "cf": "daily_capacity_factor_pct", "avail": "availability_pct"}
STATE_KEYS = [*REPORT_KEYS, "year", "month", "month_label", "max_daily_offline_hours"]
_STATE_VALUES = ["n_days", *[f"{p}_{k}" for k in _SUMS for p in ("sum", "n")]]


def report_state(daily: DataFrame, sign: int = 1, scale: int = DEFAULT_SCALE) -> DataFrame:
    """Partial figures per site, month and offline hours of a day: number of days,
    exact sums and counts. With ``sign=-1`` those of days to take away. Any two
    states add up with :func:`merged_state`."""
    day = [F.year("date").alias("year"), F.month("date").alias("month"), F.date_format("date", "yyyy-MM").alias("month_label"),
           F.col("hours_offline").alias("max_daily_offline_hours")]
    aggs = [(F.count(F.lit(1)) * sign).alias("n_days")]
    for k, c in _SUMS.items():
        aggs += [(F.coalesce(F.sum(exact(c, scale)), F.lit(0)) * sign).cast(f"decimal(38,{scale})").alias(f"sum_{k}"), (F.count(exact(c, scale)) * sign).alias(f"n_{k}")]
    return daily.groupBy(*REPORT_KEYS, *day).agg(*aggs)


def _added(states: Sequence[DataFrame], scale: int = DEFAULT_SCALE) -> DataFrame:
    return reduce(DataFrame.unionByName, states).groupBy(*STATE_KEYS).agg(*[
        F.sum(c).cast(f"decimal(38,{scale})" if c.startswith("sum_") else "bigint").alias(c) for c in _STATE_VALUES])


def merged_state(*states: DataFrame) -> DataFrame:
    """A state and its changes added up; what adds up to no day is gone."""
    return _added(states).filter("n_days <> 0")


def changed_state(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a change of daily rows, ``before`` to ``after``, adds to the state. (A
    changed day may add no day and yet other sums, so nothing is left out here.)"""
    return _added([report_state(before, -1), report_state(after, 1)])


def report_from_state(state: DataFrame, scale: int = DEFAULT_SCALE) -> DataFrame:
    """The monthly report, as :func:`gold.site_efficiency_report` gives it."""
    total = state.groupBy(*STATE_KEYS[:-1]).agg(
        F.max(F.when(F.col("n_days") > 0, F.col("max_daily_offline_hours"))).alias("max_daily_offline_hours"),
        F.sum(F.when(F.col("max_daily_offline_hours") > 0, F.col("n_days")).otherwise(0)).cast("bigint").alias("days_with_outage"),
        *[F.sum(c).alias(c) for c in _STATE_VALUES])

    def mean(k: str) -> Column:
        """As an average over the decimals has it."""
        n = F.col(f"n_{k}").cast("decimal(10,0)")
        return F.when(F.col(f"n_{k}") > 0, (F.col(f"sum_{k}").cast(f"decimal(30,{scale})") / n).cast(f"decimal(38,{scale + 4})"))

    cf, avail = mean("cf"), mean("avail")
    return total.select(
        *STATE_KEYS[:-1], F.when(F.col("n_mwh") > 0, round_double("sum_mwh", 2)).alias("monthly_production_mwh"),
        round_double(cf, 2).alias("avg_capacity_factor_pct"), round_double(avail, 1).alias("avg_availability_pct"),
        "days_with_outage", "max_daily_offline_hours",
        round_double(avail * F.lit(0.4).cast("decimal(2,1)") + cf * F.lit(0.6).cast("decimal(2,1)"), 1).alias("performance_score"))
