"""Silver layer: clean, deduplicate, unify and enrich readings.

Solar and wind differ only in a small :class:`TechSpec` (sensor columns,
which readings cannot be negative, the efficiency formula), so one cleaning
function replaces two copied chains. All technologies are unioned *before*
deduplication, so the dedup is a single shuffle on
``(technology, timestamp, site_id)`` instead of one per technology.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowatt import constants as K
from kilowatt.functions.expressions import (capacity_factor_pct, exact, exact_avg, null_if_negative,
                                            round_double, safe_double,
                                            solar_efficiency_pct, standardise_status)
from kilowatt.operators.joins import join_dimension


@dataclass(frozen=True)
class TechSpec:
    technology: str
    sensor_1: str
    sensor_2: str
    non_negative: tuple[str, ...]
    efficiency: Callable[[], Column] | None = None


SOLAR = TechSpec("solar", "panel_temp_c", "irradiance_w_m2",
                 ("production_kwh", "irradiance_w_m2"),
                 lambda: solar_efficiency_pct("production_kwh", "irradiance_w_m2"))
WIND = TechSpec("wind", "wind_speed_ms", "wind_direction_deg",
                ("production_kwh", "wind_speed_ms"), None)
SPECS = {"solar": SOLAR, "wind": WIND}


def drop_audit(df: DataFrame, prefix: str = K.AUDIT_PREFIX) -> DataFrame:
    """Drop bronze audit columns (every column whose name starts with ``prefix``)."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def clean_readings(df: DataFrame, non_negative: Iterable[str] = ("production_kwh",),
                   status: str = "status") -> DataFrame:
    """Negative readings → NULL; status outside the whitelist → UNKNOWN."""
    cols = {c: null_if_negative(c) for c in non_negative if c in df.columns}
    if status in df.columns:
        cols[status] = standardise_status(status)
    return df.withColumns(cols)


def dedup_keep_best(df: DataFrame, keys: Sequence[str] = ("timestamp", "site_id"),
                    order: str = "production_kwh", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: highest ``order`` (NULLs last), then the smallest
    ``tiebreak`` values. The ``row_number() == 1`` shape lets Catalyst insert a
    partial WindowGroupLimit *before* the shuffle, so duplicates of a hot key
    collapse to one row per map task and a skewed key cannot flood one reducer."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(),
                                          *[F.col(c).asc_nulls_last() for c in tiebreak])
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def drop_exact_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``dropDuplicates``: whole-row (or ``subset``) duplicates removed; the hash
    aggregate combines map-side first, so a hot key is pre-reduced."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def _project_tech(df: DataFrame, spec: TechSpec, keep: Sequence[str]) -> DataFrame:
    """Cleaned readings of one technology in the common (pre-dedup) shape."""
    df = clean_readings(drop_audit(df), spec.non_negative)
    eff = spec.efficiency() if spec.efficiency else F.lit(None).cast("double")
    common = ["timestamp", "site_id", "technology", "production_kwh", "status",
              "sensor_metric_1", "sensor_metric_2", "efficiency_pct"]
    return df.select(
        "timestamp", "site_id", F.lit(spec.technology).alias("technology"),
        "production_kwh", "status",
        F.col(spec.sensor_1).cast("double").alias("sensor_metric_1"),
        F.col(spec.sensor_2).cast("double").alias("sensor_metric_2"),
        eff.alias("efficiency_pct"), *[c for c in keep if c not in common])


def derive_calendar(df: DataFrame) -> DataFrame:
    """date, hour and the three-valued ``is_production`` flag."""
    return df.withColumns({
        "date": F.to_date("timestamp"),
        "hour": F.hour("timestamp"),
        "is_production": F.col("production_kwh") > 0,
    })


def silver_production(sources: dict[str, DataFrame], specs: dict[str, TechSpec] | None = None,
                      tiebreak: Sequence[str] = (), keys: Sequence[str] = ("timestamp", "site_id"),
                      ) -> DataFrame:
    """Unified silver fact table (``SILVER_COLUMNS``) from bronze tables keyed by
    technology: clean → project → union → one keep-best dedup → calendar.
    ``tiebreak`` names raw columns (e.g. an event id) or common silver columns
    (e.g. ``sensor_metric_1``) that order rows with equal production."""
    specs = specs or SPECS
    # a total order over the kept columns: the kept row never depends on
    # arrival order, so a recomputed task (lost executor) picks the same row
    tiebreak = list(tiebreak) or ["status", "sensor_metric_1", "sensor_metric_2"]
    parts = [_project_tech(df, specs[tech], tiebreak) for tech, df in sources.items()]
    unified = parts[0]
    for p in parts[1:]:
        unified = unified.unionByName(p)
    deduped = dedup_keep_best(unified, ("technology", *keys), "production_kwh", tiebreak)
    return derive_calendar(deduped).select(*K.SILVER_COLUMNS)


def silver_technology(df: DataFrame, spec: TechSpec, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One technology's silver rows (reference order: clean, dedup, derive)."""
    return silver_production({spec.technology: df}, {spec.technology: spec}, tiebreak)


def typed_sites(sites: DataFrame) -> DataFrame:
    """Site attributes with numeric columns as double; malformed text → NULL."""
    return sites.select("site_id", "site_name", "region",
                        safe_double("capacity_mw").alias("capacity_mw"),
                        safe_double("latitude").alias("latitude"),
                        safe_double("longitude").alias("longitude"))


def enrich_sites(production: DataFrame, sites: DataFrame, broadcast_sites: bool = False) -> DataFrame:
    """Left join facts → sites on ``site_id`` (Spark picks the strategy by size;
    ``broadcast_sites`` is a hint for callers who know it) and add the hourly capacity factor (NULL unless capacity > 0)."""
    out = join_dimension(production, typed_sites(sites), "site_id", "left", broadcast_sites)
    return out.withColumn("capacity_factor_pct",
                          capacity_factor_pct("production_kwh", "capacity_mw"))


def validation_profile(production: DataFrame) -> DataFrame:
    """Per technology: rows, sites, rounded avg/max production and counts of
    OFFLINE / NULL-production rows (NULL, not 0, when there are none). A reading
    that is NaN, infinite or beyond 1e26 has no exact decimal and counts in
    neither average nor maximum."""
    return (production.groupBy("technology").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("site_id").alias("nb_sites"),
        round_double(exact_avg("production_kwh"), 2).alias("avg_production_kwh"),
        round_double(F.max(F.when(exact("production_kwh").isNotNull(), F.col("production_kwh"))), 2).alias("max_production_kwh"),
        F.sum(F.when(F.col("status") == K.OFFLINE, 1)).cast("bigint").alias("offline_count"),
        F.sum(F.when(F.col("production_kwh").isNull(), 1)).cast("bigint").alias("null_production_count"),
    ))
