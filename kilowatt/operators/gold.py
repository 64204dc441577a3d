"""Gold layer: daily KPIs, day-over-day / rolling / rank enrichment and the
monthly site efficiency report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowatt import constants as K
from kilowatt.functions.expressions import (DEFAULT_SCALE, availability_pct, count_when, day_over_day_pct,
                                            exact, exact_avg, exact_sum, round_double)
from kilowatt.operators.joins import join_dimension
from kilowatt.operators.silver import typed_sites

DAILY_KEYS = ["date", "site_id", "technology"]
DAILY_COLUMNS = ["date", "site_id", "technology", "site_name", "region", "capacity_mw",
                 "total_production_kwh", "total_production_mwh", "avg_hourly_production_kwh",
                 "peak_production_kwh", "total_hours", "hours_ok", "hours_offline",
                 "hours_degraded", "availability_pct", "daily_capacity_factor_pct"]


def _daily_aggs(scale: int) -> list[Column]:
    kwh, st = F.col("production_kwh"), F.col("status")
    return [
        exact_sum(kwh, scale).alias("_sum_kwh"),
        exact_avg(kwh, scale).alias("_avg_kwh"),
        F.max(kwh).alias("_max_kwh"),
        F.count(F.lit(1)).alias("total_hours"),
        count_when(st == "OK").alias("hours_ok"),
        count_when(st == K.OFFLINE).alias("hours_offline"),
        count_when(st == "DEGRADED").alias("hours_degraded"),
        availability_pct(st).alias("availability_pct"),
    ]


def _daily_finish(df: DataFrame, computed_at: Column | None) -> DataFrame:
    s, cap = F.col("_sum_kwh"), F.col("capacity_mw")
    out = df.select(
        *DAILY_COLUMNS[:6],
        round_double(s, 2).alias("total_production_kwh"),
        round_double(s / 1000, 4).alias("total_production_mwh"),
        round_double(F.col("_avg_kwh"), 2).alias("avg_hourly_production_kwh"),
        round_double(F.col("_max_kwh"), 2).alias("peak_production_kwh"),
        "total_hours", "hours_ok", "hours_offline", "hours_degraded", "availability_pct",
        F.when(cap > 0, round_double(s.cast("double") / (cap * 1000 * K.HOURS_PER_DAY) * 100, 2))
        .otherwise(F.lit(None).cast("double")).alias("daily_capacity_factor_pct"),
    )
    if computed_at is not None:
        out = out.withColumn("computed_at", computed_at)
    return out


def daily_kpis(production: DataFrame, sites: DataFrame | None = None, scale: int = DEFAULT_SCALE,
               computed_at: Column | None = None, broadcast_sites: bool = False) -> DataFrame:
    """One row per (date, site, technology) with production, hours by status,
    availability % and daily capacity factor %.

    With ``sites`` the readings are aggregated *first* (partial aggregation
    map-side, then a shuffle of one row per site-day and map task) and the
    small daily result is joined to the site dimension — the hourly facts are
    never shuffled or joined. This equals join-then-group whenever ``site_id``
    is the key of ``sites``. Without ``sites`` the site columns already on the
    (enriched) silver table are grouping keys.
    """
    if sites is None:
        grouped = production.groupBy(*DAILY_COLUMNS[:6]).agg(*_daily_aggs(scale))
        return _daily_finish(grouped, computed_at)
    per_day = production.groupBy(*DAILY_KEYS).agg(*_daily_aggs(scale))
    s = typed_sites(sites).select("site_id", "site_name", "region", "capacity_mw")
    joined = join_dimension(per_day, s, "site_id", "left", broadcast_sites)
    return _daily_finish(joined, computed_at)


def daily_production(production: DataFrame, scale: int = DEFAULT_SCALE) -> DataFrame:
    """date, site_id, technology, total_production_mwh only — the same values as
    :func:`daily_kpis` without the site dimension, for consumers that need no
    site attribute (a left join to a keyed dimension cannot change them)."""
    return (production.groupBy(*DAILY_KEYS)
            .agg(round_double(exact_sum("production_kwh", scale) / 1000, 4).alias("total_production_mwh")))


def top_days(daily: DataFrame, n: int = 20, tiebreak: Sequence[str] = ("site_id", "technology")
             ) -> DataFrame:
    """The ``n`` newest / most productive site-days (a top-k report:
    TakeOrderedAndProject keeps n rows per task, never a global sort)."""
    return daily.orderBy(F.col("date").desc(), F.col("total_production_mwh").desc(),
                         *[F.col(c).asc() for c in tiebreak]).limit(n)


def enrich_daily(daily: DataFrame, site_keys: Sequence[str] = ("site_id",),
                 rolling_rows: int = 7, scale: int = DEFAULT_SCALE, rank_strategy: str = "window",
                 calendar: bool = False) -> DataFrame:
    """Add prev_day_production_mwh (LAG 1), day_over_day_change_pct, a
    ``rolling_rows``-row moving average (rows, not calendar days) and the
    dense rank of the site within (date, technology).

    The lag and the moving average share one window spec, hence one shuffle;
    the rank needs a second partitioning. ``rank_strategy="bucketed"`` ranks a
    (date, technology) group in value ranges instead of one task, for days
    that hold a large share of all site-days; sites of equal production are
    told apart by ``site_id``, so they can be split. A hybrid site's two rows
    of a day follow one another by technology. ``calendar=True``
    makes the previous day the *calendar* previous day (NULL after a gap) and
    the moving average span ``rolling_rows`` calendar days (RANGE frame).
    Both frames sort by the same key, so they still share one shuffle."""
    mwh = F.col("total_production_mwh")
    if calendar:
        # a calendar day has one row per site and technology
        site_keys = [*site_keys, *(["technology"] if "technology" not in site_keys else [])]
    w_site = Window.partitionBy(*site_keys).orderBy("date", *[c for c in ("technology",) if c not in site_keys])
    if calendar:
        # frames in calendar days: a missing day is a gap, not a shorter step
        day = F.unix_date("date")
        w_roll = Window.partitionBy(*site_keys).orderBy(day).rangeBetween(-(rolling_rows - 1), 0)
        prev = F.when(F.date_add(F.lag("date", 1).over(w_site), 1) == F.col("date"),
                      F.lag(mwh, 1).over(w_site))
    else:
        w_roll = w_site.rowsBetween(-(rolling_rows - 1), 0)
        prev = F.lag(mwh, 1).over(w_site)
    out = (daily
           .withColumn("prev_day_production_mwh", prev)
           .withColumn("day_over_day_change_pct",
                       day_over_day_pct(mwh, "prev_day_production_mwh"))
           .withColumn(f"rolling_{rolling_rows}d_avg_mwh",
                       round_double(F.avg(exact(mwh, scale)).over(w_roll), 4)))
    if rank_strategy == "window":
        w_rank = Window.partitionBy("date", "technology").orderBy(mwh.desc())
        return out.withColumn("daily_rank_in_technology", F.dense_rank().over(w_rank))
    if rank_strategy == "bucketed":
        from kilowatt.operators.ranking import bucketed_rank
        cols = out.columns
        r = bucketed_rank(out, ["date", "technology"], "total_production_mwh", True, ("site_id",))
        return r.select(*cols, F.col("dense_rank").cast("int").alias("daily_rank_in_technology"))
    raise ValueError(f"unknown rank_strategy {rank_strategy!r}")


def next_day(daily: DataFrame, site_keys: Sequence[str] = ("site_id", "technology"),
             value: str = "total_production_mwh") -> DataFrame:
    """LEAD 1: the next day's value for the same site (NULL on its last day)."""
    w = Window.partitionBy(*site_keys).orderBy("date")
    return daily.withColumn(f"next_day_{value}", F.lead(value, 1).over(w))


REPORT_KEYS = ["site_id", "site_name", "region", "technology", "capacity_mw"]


def site_efficiency_report(daily: DataFrame, scale: int = DEFAULT_SCALE,
                           computed_at: Column | None = None) -> DataFrame:
    """Monthly per-site report: production, mean capacity factor and
    availability, outage days, worst offline day and a composite score
    round(avg(availability) × 0.4 + avg(capacity factor) × 0.6, 1)."""
    avail, cf = exact(F.col("availability_pct"), scale), exact(F.col("daily_capacity_factor_pct"), scale)
    out = (daily.groupBy(*REPORT_KEYS,
                         F.year("date").alias("year"), F.month("date").alias("month"),
                         F.date_format("date", "yyyy-MM").alias("month_label"))
           .agg(round_double(exact_sum("total_production_mwh", scale), 2).alias("monthly_production_mwh"),
                round_double(F.avg(cf), 2).alias("avg_capacity_factor_pct"),
                round_double(F.avg(avail), 1).alias("avg_availability_pct"),
                count_when(F.col("hours_offline") > 0).alias("days_with_outage"),
                F.max("hours_offline").alias("max_daily_offline_hours"),
                round_double(F.avg(avail) * F.lit(0.4).cast("decimal(2,1)")
                             + F.avg(cf) * F.lit(0.6).cast("decimal(2,1)"), 1).alias("performance_score")))
    if computed_at is not None:
        out = out.withColumn("computed_at", computed_at)
    return out


def report_order(report: DataFrame) -> list[Column]:
    """The report's presentation order (month, score best first)."""
    return [F.col("month_label").asc(), F.col("performance_score").desc_nulls_last(),
            F.col("site_id").asc(), F.col("technology").asc()]
