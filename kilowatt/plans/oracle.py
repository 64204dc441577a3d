"""Oracle SQL (DuckDB dialect, ANSI where possible) for every registered query.

Written independently of the Spark code, in the reference's own shapes
(join-then-group, one dedup per technology, ...). Rounding rules that keep
the two engines bit-identical:

* sums/averages are taken over ``DECIMAL(38,12)`` (order independent, no value
  is rounded before it is summed);
* every ROUND goes through ``DECIMAL(38,12)`` (DuckDB rounds the binary
  double, Spark rounds its decimal text — 1.005 differs otherwise);
* integer sums are cast to BIGINT (DuckDB gives HUGEINT).
"""

from __future__ import annotations


def R(expr: str, n: int) -> str:
    """HALF_UP round of ``expr`` to ``n`` places, as DOUBLE."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def RD(expr: str, n: int) -> str:
    """HALF_UP round of a double as it is printed (17 digits tell doubles apart)."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,15)), {n}) AS DOUBLE)"


def D(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(38,12))"


def D4(expr: str) -> str:
    """A value that already has four decimals."""
    return f"CAST({expr} AS DECIMAL(18,4))"


def RATIO(num: str, den: str, mult: int, n: int) -> str:
    """Exact HALF_UP round(num / den × mult, n) as DOUBLE, NULL when den is 0
    or NULL. DuckDB divides decimals in double precision, so the quotient is
    formed on scaled integers instead (num, den: 4-decimal values)."""
    a = f"CAST({D4(num)} * 10000 AS HUGEINT)"
    b = f"CAST({D4(den)} * 10000 AS HUGEINT)"
    k = mult * 10 ** n
    r = f"sign({a}) * sign({b}) * ((2 * {k} * abs({a}) + abs({b})) // (2 * abs({b})))"
    return f"CASE WHEN {b} = 0 THEN NULL ELSE CAST({r} AS DOUBLE) / {10 ** n} END"


READINGS = """
readings AS (
  SELECT event_id,
         date_trunc('hour', ts) AS "timestamp",
         CASE WHEN user_id % 13 = 5 THEN user_id + 1000000 ELSE user_id END AS site_id,
         CASE WHEN (CASE WHEN user_id % 10 = 0 THEN event_id ELSE user_id END) % 2 = 0 THEN 'solar' ELSE 'wind' END AS technology,
         value - 10 AS production_kwh,
         CAST((event_id % 60) - 10 AS DOUBLE) AS sensor_1,
         CAST((event_id * 37 % 1100) - 100 AS DOUBLE) + (event_id % 7) * CAST(0.00001 AS DOUBLE) AS sensor_2,
         CASE event_type WHEN 'error' THEN 'OFFLINE' WHEN 'signup' THEN 'DEGRADED'
              WHEN 'purchase' THEN 'MAINT' WHEN 'click' THEN 'OK' WHEN 'view' THEN 'OK' END AS status
  FROM events
)"""

SITES = """
sites AS (
  SELECT c_custkey AS site_id, c_name AS site_name, r_name AS region,
         c_acctbal / 1000 AS capacity_mw,
         CAST(n_nationkey * 3 - 30 AS DOUBLE) AS latitude,
         CAST(r_regionkey * 30 - 60 AS DOUBLE) AS longitude
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

SOLAR_RAW = """
solar_raw AS (
  SELECT event_id, "timestamp", site_id, sensor_1 AS panel_temp_c, sensor_2 AS irradiance_w_m2,
         production_kwh, status
  FROM readings WHERE technology = 'solar'
)"""

WIND_RAW = """
wind_raw AS (
  SELECT event_id, "timestamp", site_id, sensor_1 AS wind_speed_ms,
         CAST(event_id * 37 % 360 AS INTEGER) AS wind_direction_deg, production_kwh, status
  FROM readings WHERE technology = 'wind'
)"""

_CLEAN_STATUS = "CASE WHEN status IN ('OK', 'DEGRADED', 'OFFLINE') THEN status ELSE 'UNKNOWN' END"

SOLAR_SILVER = f"""
solar_clean AS (
  SELECT event_id, "timestamp", site_id, panel_temp_c,
         CASE WHEN irradiance_w_m2 < 0 THEN NULL ELSE irradiance_w_m2 END AS irradiance_w_m2,
         CASE WHEN production_kwh < 0 THEN NULL ELSE production_kwh END AS production_kwh,
         {_CLEAN_STATUS} AS status
  FROM solar_raw
),
solar_dedup AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY "timestamp", site_id
                                 ORDER BY production_kwh DESC NULLS LAST, event_id ASC) AS rn
    FROM solar_clean) WHERE rn = 1
),
solar_silver AS (
  SELECT "timestamp", site_id, 'solar' AS technology, production_kwh, status,
         panel_temp_c AS sensor_metric_1, irradiance_w_m2 AS sensor_metric_2,
         CAST("timestamp" AS DATE) AS date, CAST(hour("timestamp") AS INTEGER) AS hour,
         production_kwh > 0 AS is_production,
         CASE WHEN irradiance_w_m2 > 0 AND production_kwh IS NOT NULL
              THEN {RD("production_kwh / (irradiance_w_m2 * CAST(0.01 AS DOUBLE))", 2)} END AS efficiency_pct
  FROM solar_dedup
)"""

WIND_SILVER = f"""
wind_clean AS (
  SELECT event_id, "timestamp", site_id,
         CASE WHEN wind_speed_ms < 0 THEN NULL ELSE wind_speed_ms END AS wind_speed_ms,
         wind_direction_deg,
         CASE WHEN production_kwh < 0 THEN NULL ELSE production_kwh END AS production_kwh,
         {_CLEAN_STATUS} AS status
  FROM wind_raw
),
wind_dedup AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY "timestamp", site_id
                                 ORDER BY production_kwh DESC NULLS LAST, event_id ASC) AS rn
    FROM wind_clean) WHERE rn = 1
),
wind_silver AS (
  SELECT "timestamp", site_id, 'wind' AS technology, production_kwh, status,
         wind_speed_ms AS sensor_metric_1, CAST(wind_direction_deg AS DOUBLE) AS sensor_metric_2,
         CAST("timestamp" AS DATE) AS date, CAST(hour("timestamp") AS INTEGER) AS hour,
         production_kwh > 0 AS is_production,
         CAST(NULL AS DOUBLE) AS efficiency_pct
  FROM wind_dedup
)"""

PRODUCTION = """
production AS (
  SELECT * FROM solar_silver
  UNION ALL
  SELECT * FROM wind_silver
)"""

ENRICHED = f"""
enriched AS (
  SELECT p.*, s.site_name, s.region, s.capacity_mw, s.latitude, s.longitude,
         CASE WHEN s.capacity_mw > 0
              THEN {R("p.production_kwh / (s.capacity_mw * 1000) * 100", 2)} END AS capacity_factor_pct
  FROM production p LEFT JOIN sites s USING (site_id)
)"""

DAILY = f"""
daily AS (
  SELECT p.date, p.site_id, p.technology, s.site_name, s.region,
         CAST(s.capacity_mw AS DOUBLE) AS capacity_mw,
         {R(f"SUM({D('p.production_kwh')})", 2)} AS total_production_kwh,
         {R(f"SUM({D('p.production_kwh')}) / 1000", 4)} AS total_production_mwh,
         {R(f"AVG({D('p.production_kwh')})", 2)} AS avg_hourly_production_kwh,
         {R("MAX(p.production_kwh)", 2)} AS peak_production_kwh,
         COUNT(*) AS total_hours,
         CAST(SUM(CASE WHEN p.status = 'OK' THEN 1 ELSE 0 END) AS BIGINT) AS hours_ok,
         CAST(SUM(CASE WHEN p.status = 'OFFLINE' THEN 1 ELSE 0 END) AS BIGINT) AS hours_offline,
         CAST(SUM(CASE WHEN p.status = 'DEGRADED' THEN 1 ELSE 0 END) AS BIGINT) AS hours_degraded,
         {R("SUM(CASE WHEN p.status != 'OFFLINE' THEN 1 ELSE 0 END) * 100.0 / COUNT(*)", 1)} AS availability_pct,
         CASE WHEN CAST(s.capacity_mw AS DOUBLE) > 0 THEN
           {R(f"CAST(SUM({D('p.production_kwh')}) AS DOUBLE) / (CAST(s.capacity_mw AS DOUBLE) * 1000 * 24) * 100", 2)}
         END AS daily_capacity_factor_pct
  FROM production p
  LEFT JOIN sites s USING (site_id)
  GROUP BY p.date, p.site_id, p.technology, s.site_name, s.region, s.capacity_mw
)"""

SILVER_CHAIN = [READINGS, SOLAR_RAW, WIND_RAW, SOLAR_SILVER, WIND_SILVER, PRODUCTION]


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _q(*ctes: str, body: str) -> str:
    return with_ctes(list(ctes), body)


BRONZE = [READINGS, SOLAR_RAW, WIND_RAW]

ORACLE: dict[str, str] = {}

ORACLE["clean_readings"] = _q(READINGS, body="""
SELECT event_id, "timestamp", site_id, technology,
       CASE WHEN production_kwh < 0 THEN NULL ELSE production_kwh END AS production_kwh,
       sensor_1,
       CASE WHEN sensor_2 < 0 THEN NULL ELSE sensor_2 END AS sensor_2,
       CASE WHEN status IN ('OK', 'DEGRADED', 'OFFLINE') THEN status ELSE 'UNKNOWN' END AS status,
       (CASE WHEN production_kwh < 0 THEN NULL ELSE production_kwh END) > 0 AS is_production
FROM readings""")

ORACLE["dedup_keep_best"] = _q(READINGS, body="""
SELECT event_id, "timestamp", site_id, technology, production_kwh, status FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY technology, "timestamp", site_id
                               ORDER BY production_kwh DESC NULLS LAST, event_id ASC) AS rn
  FROM (SELECT event_id, "timestamp", site_id, technology,
               CASE WHEN production_kwh < 0 THEN NULL ELSE production_kwh END AS production_kwh,
               CASE WHEN status IN ('OK', 'DEGRADED', 'OFFLINE') THEN status ELSE 'UNKNOWN' END AS status
        FROM readings) c) d
WHERE rn = 1""")

ORACLE["dedup_distinct"] = _q(READINGS, body="""
SELECT DISTINCT site_id, "timestamp", technology, status FROM readings""")

ORACLE["unify_production"] = _q(*SILVER_CHAIN, body="SELECT * FROM production")

ORACLE["enrich_sites"] = _q(*SILVER_CHAIN, SITES, ENRICHED, body="SELECT * FROM enriched")

ORACLE["daily_kpis"] = _q(*SILVER_CHAIN, SITES, DAILY, body="SELECT * FROM daily")

ORACLE["daily_kpis_top20"] = _q(*SILVER_CHAIN, SITES, DAILY, body="""
SELECT * FROM daily ORDER BY date DESC, total_production_mwh DESC, site_id, technology LIMIT 20""")

ORACLE["daily_kpis_enriched"] = _q(*SILVER_CHAIN, SITES, DAILY, body=f"""
SELECT *,
       {RATIO(f"{D4('total_production_mwh')} - {D4('prev_day_production_mwh')}", "prev_day_production_mwh", 100, 2)}
         AS day_over_day_change_pct,
       {R(f"AVG({D('total_production_mwh')}) OVER (PARTITION BY site_id ORDER BY date, technology ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 4)}
         AS rolling_7d_avg_mwh,
       CAST(DENSE_RANK() OVER (PARTITION BY date, technology ORDER BY total_production_mwh DESC NULLS LAST) AS INTEGER)
         AS daily_rank_in_technology
FROM (SELECT *, LAG(total_production_mwh, 1) OVER (PARTITION BY site_id ORDER BY date, technology)
                  AS prev_day_production_mwh
      FROM daily) d""")

ORACLE["site_efficiency_report"] = _q(*SILVER_CHAIN, SITES, DAILY, body=f"""
SELECT site_id, site_name, region, technology, capacity_mw,
       CAST(YEAR(date) AS INTEGER) AS year, CAST(MONTH(date) AS INTEGER) AS month,
       strftime(date, '%Y-%m') AS month_label,
       {R(f"SUM({D('total_production_mwh')})", 2)} AS monthly_production_mwh,
       {R(f"AVG({D('daily_capacity_factor_pct')})", 2)} AS avg_capacity_factor_pct,
       {R(f"AVG({D('availability_pct')})", 1)} AS avg_availability_pct,
       CAST(SUM(CASE WHEN hours_offline > 0 THEN 1 ELSE 0 END) AS BIGINT) AS days_with_outage,
       MAX(hours_offline) AS max_daily_offline_hours,
       {R(f"AVG({D('availability_pct')}) * 0.4 + AVG({D('daily_capacity_factor_pct')}) * 0.6", 1)} AS performance_score
FROM daily
GROUP BY site_id, site_name, region, technology, capacity_mw, YEAR(date), MONTH(date), strftime(date, '%Y-%m')""")

ORACLE["enriched_incremental"] = ORACLE["daily_kpis_enriched"]
ORACLE["report_incremental"] = ORACLE["site_efficiency_report"]

ORACLE["validation_profile"] = _q(*SILVER_CHAIN, body=f"""
SELECT technology,
       COUNT(*) AS total_records,
       COUNT(DISTINCT site_id) AS nb_sites,
       {R(f"AVG({D('production_kwh')})", 2)} AS avg_production_kwh,
       {R("MAX(production_kwh)", 2)} AS max_production_kwh,
       CAST(SUM(CASE WHEN status = 'OFFLINE' THEN 1 END) AS BIGINT) AS offline_count,
       CAST(SUM(CASE WHEN production_kwh IS NULL THEN 1 END) AS BIGINT) AS null_production_count
FROM production
GROUP BY technology""")

_PROFILE = """
SELECT '{name}' AS table_name,
       COUNT(*) AS total_rows,
       COUNT(DISTINCT site_id) AS distinct_sites,
       CAST(SUM(CASE WHEN production_kwh IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_production,
       CAST(SUM(CASE WHEN production_kwh < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_production,
       CAST(SUM(CASE WHEN status = 'OFFLINE' THEN 1 ELSE 0 END) AS BIGINT) AS offline_records,
       MIN("timestamp") AS min_ts,
       MAX("timestamp") AS max_ts
FROM {name}"""

ORACLE["bronze_profile"] = _q(*BRONZE, body=_PROFILE.format(name="solar_raw") + "\nUNION ALL"
                              + _PROFILE.format(name="wind_raw"))

ANOMALY_INPUT = f"""
anomaly_input AS (
  SELECT date, site_id, technology,
         CASE WHEN site_id % 2 = 1
              THEN CAST(500 - {D('total_production_mwh')} AS DOUBLE)
              ELSE total_production_mwh END AS total_production_mwh
  FROM daily
)"""

_ANOMALY_CORE = f"""
rolling_stats AS (
  SELECT date, site_id, technology, total_production_mwh,
         AVG({D('total_production_mwh')}) OVER (PARTITION BY site_id ORDER BY date, technology
             ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30d_avg,
         STDDEV_SAMP(total_production_mwh) OVER (PARTITION BY site_id ORDER BY date, technology
             ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30d_std
  FROM anomaly_input
),
anomalies AS (
  SELECT *, {R("(total_production_mwh - rolling_30d_avg) / NULLIF(rolling_30d_std, 0)", 2)} AS z_score
  FROM rolling_stats
)"""

ORACLE["detect_anomalies"] = _q(*SILVER_CHAIN, SITES, DAILY, ANOMALY_INPUT, _ANOMALY_CORE, body=f"""
SELECT date, site_id, technology,
       {R("total_production_mwh", 3)} AS production_mwh,
       {R("rolling_30d_avg", 3)} AS avg_30d,
       z_score,
       CASE WHEN z_score < -2 THEN '🔴 ANOMALIE BASSE'
            WHEN z_score < -1 THEN '🟡 Production faible'
            WHEN z_score > 2 THEN '🔵 Production exceptionnelle'
            ELSE '✅ Normal' END AS alert_level
FROM anomalies
WHERE ABS(z_score) > 1.5
ORDER BY ABS(z_score) DESC, site_id, date, technology
LIMIT 30""")

_RULES = ["CASE WHEN NOT COALESCE(production_kwh IS NULL OR production_kwh >= 0, TRUE) THEN 'chk_production_positive' END",
          "CASE WHEN NOT COALESCE(technology IN ('solar', 'wind'), TRUE) THEN 'chk_technology_valid' END",
          "CASE WHEN NOT COALESCE(sensor_2 IS NULL OR sensor_2 >= 0, TRUE) THEN 'chk_irradiance_positive' END"]

ORACLE["expect_quarantine"] = _q(READINGS, body=f"""
SELECT * FROM (
  SELECT *,
         concat_ws(',', {', '.join(_RULES)}) AS failed_rules
  FROM readings) q
WHERE failed_rules <> ''""")

ORACLE["not_null_report"] = _q(*SILVER_CHAIN, body="\nUNION ALL".join(f"""
SELECT 'nn_{c}' AS rule, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS violations FROM production"""
                                                                       for c in ("site_id", "production_kwh", "sensor_metric_2", "efficiency_pct")))

ORACLE["expect_report"] = _q(READINGS, body="""
SELECT 'chk_production_positive' AS rule,
       CAST(SUM(CASE WHEN NOT COALESCE(production_kwh IS NULL OR production_kwh >= 0, TRUE) THEN 1 ELSE 0 END) AS BIGINT) AS violations
FROM readings
UNION ALL
SELECT 'chk_technology_valid',
       CAST(SUM(CASE WHEN NOT COALESCE(technology IN ('solar', 'wind'), TRUE) THEN 1 ELSE 0 END) AS BIGINT)
FROM readings
UNION ALL
SELECT 'chk_irradiance_positive',
       CAST(SUM(CASE WHEN NOT COALESCE(sensor_2 IS NULL OR sensor_2 >= 0, TRUE) THEN 1 ELSE 0 END) AS BIGINT)
FROM readings""")

MERGE_CTES = """
base AS (SELECT "timestamp", site_id, technology, production_kwh, status, date, hour FROM production),
tgt AS (SELECT *, 1 AS _t FROM base WHERE date < DATE '2024-01-27'),
src AS (SELECT "timestamp", site_id, technology,
               CASE WHEN site_id % 7 = 0 THEN production_kwh + 1 ELSE production_kwh END AS production_kwh,
               status, date, hour, 1 AS _s
        FROM base WHERE date >= DATE '2024-01-20' AND (site_id + hour) % 11 <> 0),
joined AS (
  SELECT t."timestamp" AS t_ts, t.site_id AS t_site, t.technology AS t_tech, t.production_kwh AS t_kwh,
         t.status AS t_status, t.date AS t_date, t.hour AS t_hour, t._t,
         s."timestamp" AS s_ts, s.site_id AS s_site, s.technology AS s_tech, s.production_kwh AS s_kwh,
         s.status AS s_status, s.date AS s_date, s.hour AS s_hour, s._s
  FROM tgt t FULL OUTER JOIN src s ON t."timestamp" = s."timestamp" AND t.site_id = s.site_id AND t.technology = s.technology),
actions AS (
  SELECT *, CASE WHEN _s IS NULL THEN (CASE WHEN t_date >= DATE '2024-01-23' THEN 'delete' ELSE 'keep' END)
                 WHEN _t IS NULL THEN 'insert'
                 WHEN s_kwh != t_kwh THEN 'update'
                 ELSE 'keep' END AS _action
  FROM joined),
merged AS (
  SELECT CASE WHEN _action IN ('insert', 'update') THEN s_ts ELSE t_ts END AS "timestamp",
         CASE WHEN _action IN ('insert', 'update') THEN s_site ELSE t_site END AS site_id,
         CASE WHEN _action IN ('insert', 'update') THEN s_tech ELSE t_tech END AS technology,
         CASE WHEN _action IN ('insert', 'update') THEN s_kwh ELSE t_kwh END AS production_kwh,
         CASE WHEN _action IN ('insert', 'update') THEN s_status ELSE t_status END AS status,
         CASE WHEN _action IN ('insert', 'update') THEN s_date ELSE t_date END AS date,
         CASE WHEN _action IN ('insert', 'update') THEN s_hour ELSE t_hour END AS hour,
         _action
  FROM actions)"""

ORACLE["merge_upsert"] = _q(*SILVER_CHAIN, MERGE_CTES, body="SELECT * FROM merged WHERE _action <> 'delete'")

ORACLE["version_read"] = _q(*SILVER_CHAIN, MERGE_CTES, body="""
SELECT "timestamp", site_id, technology, production_kwh, status, date, hour FROM tgt""")

ORACLE["version_latest"] = _q(*SILVER_CHAIN, MERGE_CTES, body="""
SELECT "timestamp", site_id, technology, production_kwh, status, date, hour
FROM merged WHERE _action <> 'delete'""")

ORACLE["merge_partitions"] = ORACLE["version_latest"]
# dates before the source's first and outside the delete window are not written
ORACLE["merge_partitions_report"] = _q(*SILVER_CHAIN, MERGE_CTES, body="""
SELECT (SELECT COUNT(DISTINCT date) FROM tgt t WHERE date < DATE '2024-01-23' AND date NOT IN (SELECT date FROM src)) AS partitions_untouched,
       CAST(SUM(CASE WHEN _action = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS num_insert,
       CAST(SUM(CASE WHEN _action = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS num_update,
       CAST(SUM(CASE WHEN _action = 'delete' THEN 1 ELSE 0 END) AS BIGINT) AS num_delete,
       CAST(SUM(CASE WHEN _action = 'keep' THEN 1 ELSE 0 END) AS BIGINT) AS num_keep
FROM actions WHERE COALESCE(s_date, t_date) >= DATE '2024-01-23' OR COALESCE(s_date, t_date) IN (SELECT date FROM src)""")

ORACLE["merge_catalog"] = ORACLE["version_latest"]
ORACLE["merge_bucketed"] = ORACLE["merge_upsert"]

# every version is a whole snapshot: all rows but the deleted ones are written
ORACLE["history"] = _q(*SILVER_CHAIN, MERGE_CTES, body="""
SELECT CAST(1 AS BIGINT) AS version, 'MERGE' AS operation,
       CAST(SUM(CASE WHEN _action <> 'delete' THEN 1 ELSE 0 END) AS BIGINT) AS num_output_rows,
       CAST(SUM(CASE WHEN _action = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS num_inserted,
       CAST(SUM(CASE WHEN _action = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS num_updated,
       CAST(SUM(CASE WHEN _action = 'delete' THEN 1 ELSE 0 END) AS BIGINT) AS num_deleted,
       CAST(SUM(CASE WHEN _action = 'keep' THEN 1 ELSE 0 END) AS BIGINT) AS num_kept
FROM actions
UNION ALL
SELECT CAST(0 AS BIGINT), 'WRITE', (SELECT COUNT(*) FROM tgt), NULL, NULL, NULL, NULL""")

ORDER_VALUES = """
order_values AS (
  SELECT o_orderkey, o_orderpriority, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS value FROM orders
)"""

ORACLE["rank_trio"] = _q(ORDER_VALUES, body="""
SELECT *,
  CAST(DENSE_RANK() OVER (PARTITION BY o_orderpriority ORDER BY value DESC NULLS LAST) AS BIGINT) AS dense_rank,
  CAST(RANK() OVER (PARTITION BY o_orderpriority ORDER BY value DESC NULLS LAST) AS BIGINT) AS rank,
  CAST(ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY value DESC NULLS LAST, o_orderkey) AS BIGINT) AS row_number
FROM order_values""")

ORACLE["global_rank"] = _q(ORDER_VALUES, body="""
SELECT *,
  CAST(DENSE_RANK() OVER (ORDER BY value DESC NULLS LAST) AS BIGINT) AS dense_rank,
  CAST(RANK() OVER (ORDER BY value DESC NULLS LAST) AS BIGINT) AS rank,
  CAST(ROW_NUMBER() OVER (ORDER BY value DESC NULLS LAST, o_orderkey) AS BIGINT) AS row_number
FROM order_values""")

ORACLE["daily_next_day"] = _q(*SILVER_CHAIN, SITES, DAILY, body="""
SELECT date, site_id, technology, total_production_mwh,
       LEAD(total_production_mwh, 1) OVER (PARTITION BY site_id, technology ORDER BY date)
         AS next_day_total_production_mwh
FROM daily""")

_LINEITEM = "SELECT * FROM lineitem"
ORACLE["compact_layout"] = _LINEITEM
ORACLE["zorder_layout"] = _LINEITEM
ORACLE["sorted_write"] = _LINEITEM

ORACLE["partition_profile"] = _q(*SILVER_CHAIN, body="""
SELECT technology, date, COUNT(*) AS num_rows, MIN("timestamp") AS min_ts, MAX("timestamp") AS max_ts
FROM production GROUP BY technology, date""")

RAW_READINGS = """
raw_readings AS (
  SELECT ts AS "timestamp", user_id AS site_id,
         CASE WHEN user_id % 2 = 0 THEN 'solar' ELSE 'wind' END AS technology,
         value - 10 AS production_kwh
  FROM events
)"""

_ROLLUP = f"""
SELECT site_id, technology, date_trunc('{{unit}}', "timestamp") AS bucket_start,
       COUNT(*) AS n_readings,
       {R(f"SUM({D('production_kwh')})", 4)} AS total_kwh,
       {R(f"AVG({D('production_kwh')})", 4)} AS avg_kwh,
       MAX(production_kwh) AS max_kwh,
       '{{unit}}' AS unit
FROM raw_readings GROUP BY site_id, technology, date_trunc('{{unit}}', "timestamp")"""

ORACLE["timescale_rollup"] = _q(RAW_READINGS, body="\nUNION ALL".join(
    _ROLLUP.format(unit=u) for u in ("minute", "hour", "day")))

ORACLE["energy_losses"] = _q(*SILVER_CHAIN, SITES, DAILY, body=f"""
SELECT date, site_id, technology, hours_offline, capacity_mw,
       {R("mean_cf", 4)} AS mean_capacity_factor_pct,
       CASE WHEN capacity_mw > 0 THEN {R("hours_offline * CAST(capacity_mw AS DECIMAL(14,6)) * mean_cf / 100", 4)} END
         AS energy_lost_mwh
FROM (SELECT *, CAST(AVG({D('daily_capacity_factor_pct')}) OVER (PARTITION BY site_id, technology) AS DECIMAL(14,8))
                  AS mean_cf
      FROM daily) d""")

ORACLE["rows_per_technology"] = _q(*SILVER_CHAIN, body="""
SELECT technology, COUNT(*) AS count FROM production GROUP BY technology""")

ORACLE["predicates_scalars"] = _q(READINGS, body=f"""
SELECT event_id, site_id,
       CAST(YEAR("timestamp") AS INTEGER) AS year, CAST(MONTH("timestamp") AS INTEGER) AS month,
       CAST(HOUR("timestamp") AS INTEGER) AS hour, CAST("timestamp" AS DATE) AS date,
       strftime("timestamp", '%Y-%m') AS month_label,
       ABS(production_kwh) AS abs_kwh,
       {R(D('production_kwh'), 1)} AS kwh_1,
       NULLIF(sensor_2, 0.0) AS sensor_2_nz,
       production_kwh != 0 AS nonzero,
       CASE WHEN production_kwh >= 50 THEN 'high' WHEN production_kwh >= 0 THEN 'low' ELSE 'negative' END AS band,
       CAST("timestamp" AS DATE) - 7 AS week_before
FROM readings
WHERE technology = 'solar' AND (status IN ('OK', 'OFFLINE') OR production_kwh IS NULL OR production_kwh < 0)""")

def _landing(site_type: str = "VARCHAR") -> str:
    """Both kinds of landing files in one shape."""
    return f"""
SELECT 'solar' AS kind, "timestamp", CAST(site_id AS {site_type}) AS site_id, panel_temp_c AS sensor_1,
       irradiance_w_m2 AS sensor_2, production_kwh, status FROM solar_raw
UNION ALL
SELECT 'wind', "timestamp", CAST(site_id AS {site_type}), wind_speed_ms, CAST(wind_direction_deg AS DOUBLE), production_kwh, status
FROM wind_raw"""


ORACLE["csv_roundtrip"] = _q(*BRONZE, body=_landing())
ORACLE["csv_all_strings"] = _q(*BRONZE, body=f"SELECT *, TRUE AS all_strings FROM ({_landing()}) x")
# type inference reads the small site ids as INT
ORACLE["csv_inferred"] = _q(*BRONZE, body=_landing("INTEGER"))
ORACLE["stream_ingest"] = _q(*BRONZE, body=_landing())
ORACLE["bronze_audit"] = _q(*BRONZE, body=f"""
SELECT kind, 'fixture' AS batch_id, CAST(YEAR("timestamp") AS INTEGER) AS year, CAST(MONTH("timestamp") AS INTEGER) AS month,
       TRUE AS source_named, TRUE AS ingested, COUNT(*) AS num_rows
FROM ({_landing()}) x GROUP BY ALL""")
_BAD = """
SELECT '{kind}' AS kind, CASE
         WHEN event_id % 23 = 0 THEN 'fields: 4 of 6'
         WHEN event_id % 29 = 0 THEN 'fields: 7 of 6'
         WHEN event_id % 19 = 0 THEN 'timestamp: not a timestamp'
         WHEN event_id % 37 = 0 THEN '{two}: not a {type}'
         WHEN event_id % 17 = 0 THEN 'production_kwh: not a double'
         WHEN event_id % 31 = 0 THEN 'site_id: missing' END AS reason, production_kwh
FROM {table}"""
ORACLE["csv_bad_records"] = _q(*BRONZE, body=f"""
SELECT kind, reason, COUNT(*) AS num_rows, {R(f"SUM(CASE WHEN reason IS NULL THEN {D('production_kwh')} END)", 2)} AS accepted_kwh,
       CAST(SUM(CASE WHEN reason IS NULL OR reason = 'site_id: missing' THEN 0 ELSE 1 END) AS BIGINT) AS num_raw
FROM ({_BAD.format(kind="solar", two="irradiance_w_m2", type="double", table="solar_raw")}
UNION ALL{_BAD.format(kind="wind", two="wind_direction_deg", type="int", table="wind_raw")}) x
GROUP BY kind, reason""")
ORACLE["stream_schema_change"] = _q(*BRONZE, body="""
SELECT "timestamp", CAST(site_id AS VARCHAR) AS site_id, CASE WHEN event_id % 3 <> 2 THEN panel_temp_c END AS panel_temp_c, irradiance_w_m2,
       CASE WHEN event_id % 3 <> 2 OR event_id % 5 <> 0 THEN production_kwh END AS production_kwh, status,
       CASE WHEN event_id % 3 = 1 THEN 'v' || (event_id % 4) END AS firmware,
       event_id % 3 = 2 AND event_id % 5 = 0 AS rejected,
       CASE WHEN event_id % 3 = 2 AND event_id % 5 = 0 THEN 'production_kwh: not a double' END AS reason
FROM solar_raw""")
ORACLE["stream_quality"] = _q(*BRONZE, body=f"""
SELECT kind, COUNT(*) AS total_rows, COUNT(DISTINCT site_id) AS distinct_sites,
       CAST(SUM(CASE WHEN production_kwh IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_production,
       CAST(SUM(CASE WHEN production_kwh < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_production,
       CAST(SUM(CASE WHEN status = 'OFFLINE' THEN 1 ELSE 0 END) AS BIGINT) AS offline_records,
       MIN("timestamp") AS min_ts, MAX("timestamp") AS max_ts
FROM ({_landing()}) x GROUP BY kind""")
ORACLE["stream_observed"] = _q(*BRONZE, body=f"""
SELECT kind, COUNT(*) AS total_rows, CAST(SUM(CASE WHEN production_kwh IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_production,
       CAST(SUM(CASE WHEN production_kwh < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_production,
       CAST(SUM(CASE WHEN status = 'OFFLINE' THEN 1 ELSE 0 END) AS BIGINT) AS offline_records
FROM ({_landing()}) x GROUP BY kind""")
# eight landing files per kind, each at least a header and a row
ORACLE["file_inventory"] = _q(*BRONZE, body="""
SELECT 'solar' AS kind, CAST(8 AS BIGINT) AS num_files, COUNT(*) AS num_rows, TRUE AS sizes_add_up, TRUE AS names_match, TRUE AS sizes_positive
FROM solar_raw
UNION ALL
SELECT 'wind', CAST(8 AS BIGINT), COUNT(*), TRUE, TRUE, TRUE FROM wind_raw""")
ORACLE["view_sql"] = _q(*SILVER_CHAIN, body=f"""
SELECT technology, COUNT(*) AS num_rows, {R(f"SUM({D('production_kwh')})", 2)} AS total_kwh
FROM production WHERE status = 'OK' GROUP BY technology""")
ORACLE["catalog_tables"] = _q(*SILVER_CHAIN, SITES, DAILY, body=f"""
SELECT 'production' AS table_name, 'Unified readings of solar and wind sites' AS comment, COUNT(*) AS num_rows, CAST(11 AS INTEGER) AS num_columns,
       'silver' AS quality, 'date' AS partitions, CAST(0 AS BIGINT) AS commented_columns, {R(f"SUM({D('production_kwh')})", 2)} AS total
FROM production
UNION ALL
SELECT 'daily_kpis', 'Daily production KPIs per site', COUNT(*), CAST(16 AS INTEGER), 'gold', 'technology', CAST(1 AS BIGINT),
       {R(f"SUM({D('total_production_mwh')})", 2)}
FROM daily""")
ORACLE["daily_kpis_stamped"] = _q(*SILVER_CHAIN, SITES, DAILY, body="""
SELECT *, TIMESTAMP '2024-02-01 06:00:00' AS computed_at FROM daily""")
ORACLE["report_ordered_whole"] = f"""
SELECT * FROM ({ORACLE["site_efficiency_report"]}) r
ORDER BY month_label, performance_score DESC NULLS LAST, site_id, technology"""
# NULL sites and NULL dates on both sides: no key matches them, every row counts
ORACLE["merge_null_keys"] = _q(*SILVER_CHAIN, """
nbase AS (
  SELECT "timestamp", CASE WHEN hour = 3 THEN NULL ELSE site_id END AS site_id, technology, production_kwh, status,
         CASE WHEN hour = 5 THEN NULL ELSE date END AS date, hour
  FROM production),
ntgt AS (SELECT *, 1 AS t FROM nbase WHERE date IS NULL OR date < DATE '2024-01-27'),
nsrc AS (
  SELECT "timestamp", site_id, technology, CASE WHEN hour % 2 = 0 THEN production_kwh + 1 ELSE production_kwh END AS production_kwh,
         status, date, hour, 1 AS s
  FROM nbase WHERE date IS NULL OR date >= DATE '2024-01-20')""", body="""
SELECT CASE WHEN take THEN s_ts ELSE t_ts END AS "timestamp", CASE WHEN take THEN s_site ELSE t_site END AS site_id,
       CASE WHEN take THEN s_tech ELSE t_tech END AS technology, CASE WHEN take THEN s_kwh ELSE t_kwh END AS production_kwh,
       CASE WHEN take THEN s_status ELSE t_status END AS status, CASE WHEN take THEN s_date ELSE t_date END AS date,
       CASE WHEN take THEN s_hour ELSE t_hour END AS hour
FROM (
  SELECT a."timestamp" AS t_ts, a.site_id AS t_site, a.technology AS t_tech, a.production_kwh AS t_kwh, a.status AS t_status,
         a.date AS t_date, a.hour AS t_hour, b."timestamp" AS s_ts, b.site_id AS s_site, b.technology AS s_tech,
         b.production_kwh AS s_kwh, b.status AS s_status, b.date AS s_date, b.hour AS s_hour, b.s,
         a.t IS NULL OR COALESCE(a.production_kwh <> b.production_kwh, FALSE) AS take
  FROM ntgt a FULL OUTER JOIN nsrc b
    ON a."timestamp" = b."timestamp" AND a.site_id = b.site_id AND a.technology = b.technology) x
WHERE NOT (s IS NULL AND COALESCE(t_date >= DATE '2024-01-23', FALSE))""")

ORACLE["stream_dedup"] = ORACLE["dedup_distinct"]
ORACLE["stream_rollup"] = _q(RAW_READINGS, body=f"""
SELECT date_trunc('hour', "timestamp") AS window_start,
       date_trunc('hour', "timestamp") + INTERVAL 1 HOUR AS window_end,
       site_id, technology, COUNT(*) AS n_readings,
       {R(f"SUM({D('production_kwh')})", 4)} AS total_kwh,
       {R(f"AVG({D('production_kwh')})", 4)} AS avg_kwh,
       MAX(production_kwh) AS max_kwh
FROM raw_readings
GROUP BY site_id, technology, date_trunc('hour', "timestamp")
HAVING date_trunc('hour', "timestamp") + INTERVAL 1 HOUR
       <= (SELECT MAX("timestamp") FROM raw_readings) - INTERVAL 10 MINUTE""")

ORACLE["stream_multiscale"] = _q(RAW_READINGS, body=f"""
SELECT * FROM (""" + "\nUNION ALL".join(_ROLLUP.format(unit=u) for u in ("minute", "hour", "day")) + """) x
WHERE CASE unit WHEN 'minute' THEN bucket_start + INTERVAL 1 MINUTE WHEN 'hour' THEN bucket_start + INTERVAL 1 HOUR
      ELSE bucket_start + INTERVAL 1 DAY END <= (SELECT MAX("timestamp") FROM raw_readings) - INTERVAL 10 MINUTE""")
ORACLE["drift_alerts"] = _q(*SILVER_CHAIN, SITES, DAILY, RAW_READINGS, f"""
baseline AS (
  SELECT site_id, AVG({D('total_production_mwh')}) AS baseline_mean,
         STDDEV_SAMP(total_production_mwh) AS baseline_std
  FROM daily WHERE date < DATE '2024-01-20' GROUP BY site_id
),
stream_daily AS (
  SELECT CAST(date_trunc('day', "timestamp") AS DATE) AS date, site_id,
         {R(f"SUM({D('CASE WHEN production_kwh < 0 THEN NULL ELSE production_kwh END')}) / 1000", 4)} AS production_mwh
  FROM raw_readings WHERE "timestamp" >= TIMESTAMP '2024-01-20 00:00:00'
  GROUP BY site_id, CAST(date_trunc('day', "timestamp") AS DATE)
  HAVING CAST(date_trunc('day', "timestamp") AS DATE) + INTERVAL 1 DAY
         <= (SELECT MAX("timestamp") FROM raw_readings) - INTERVAL 1 HOUR
)""", body=f"""
SELECT d.date, d.site_id, d.production_mwh, {R("b.baseline_mean", 4)} AS baseline_mean,
       {R("(d.production_mwh - b.baseline_mean) / NULLIF(b.baseline_std, 0)", 2)} AS z_score,
       CASE WHEN b.site_id IS NULL THEN 'no baseline'
            WHEN {R("(d.production_mwh - b.baseline_mean) / NULLIF(b.baseline_std, 0)", 2)} < -2 THEN '🔴 ANOMALIE BASSE'
            WHEN {R("(d.production_mwh - b.baseline_mean) / NULLIF(b.baseline_std, 0)", 2)} < -1 THEN '🟡 Production faible'
            WHEN {R("(d.production_mwh - b.baseline_mean) / NULLIF(b.baseline_std, 0)", 2)} > 2 THEN '🔵 Production exceptionnelle'
            ELSE '✅ Normal' END AS alert_level
FROM stream_daily d LEFT JOIN baseline b USING (site_id)""")

ORACLE["drift_stateful"] = _q(*SILVER_CHAIN, SITES, DAILY, """
d AS (SELECT date, site_id, technology, total_production_mwh, CAST(ROUND(total_production_mwh * 10000) AS HUGEINT) AS x,
             CASE WHEN date - LAG(date) OVER (PARTITION BY site_id, technology ORDER BY date) > 3 THEN 1 ELSE 0 END AS starts
      FROM daily WHERE date IS NOT NULL),
runs AS (SELECT *, SUM(starts) OVER (PARTITION BY site_id, technology ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM d),
sums AS (SELECT *, COUNT(x) OVER w AS n, COALESCE(SUM(x) OVER w, 0) AS s, COALESCE(SUM(x * x) OVER w, 0) AS ss FROM runs
         WINDOW w AS (PARTITION BY site_id, technology, run ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / n / 10000 END AS mean,
             CASE WHEN n >= 2 AND n * ss - s * s > 0
                  THEN (CAST(x AS DOUBLE) - CAST(s AS DOUBLE) / n) / SQRT(CAST(n * ss - s * s AS DOUBLE) / (n * (n - 1))) END AS z FROM sums)""", body=f"""
SELECT date, site_id, technology, total_production_mwh, CAST(n AS BIGINT) AS baseline_days, {R("mean", 4)} AS baseline_mean, {R("z", 2)} AS z_score,
       CASE WHEN n < 2 THEN 'no baseline'
            WHEN {R("z", 2)} < -2 THEN '🔴 ANOMALIE BASSE'
            WHEN {R("z", 2)} < -1 THEN '🟡 Production faible'
            WHEN {R("z", 2)} > 2 THEN '🔵 Production exceptionnelle'
            ELSE '✅ Normal' END AS alert_level
FROM z""")

_INVENTORY = [("bronze", "bronze.sites_raw", "sites", 9), ("bronze", "bronze.solar_raw", "solar_raw", 11),
              ("bronze", "bronze.wind_raw", "wind_raw", 11), ("silver", "silver.production", "production", 17),
              ("gold", "gold.daily_kpis", "daily", 17), ("gold", "gold.daily_kpis_enriched", "daily", 21),
              ("gold", "gold.site_efficiency_report", "report", 15)]

ORACLE["layer_inventory"] = _q(*SILVER_CHAIN, SITES, DAILY, """
report AS (SELECT DISTINCT site_id, technology, YEAR(date), MONTH(date) FROM daily)""", body="\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, (SELECT COUNT(*) FROM {src}) AS num_rows, "
    f"{ncol} AS num_columns" for layer, name, src, ncol in _INVENTORY))

ORACLE["daily_rank_bucketed"] = ORACLE["daily_kpis_enriched"]

ORACLE["row_counts"] = _q(READINGS, body="""
SELECT (SELECT COUNT(*) FROM readings) AS total_rows,
       (SELECT COUNT(*) FROM (SELECT DISTINCT site_id, "timestamp", technology, status FROM readings) d)
         AS distinct_rows""")

ORACLE["schema_evolution"] = _q(READINGS, body="""
SELECT event_id, site_id, production_kwh, CAST(NULL AS VARCHAR) AS status FROM readings WHERE technology = 'solar'
UNION ALL
SELECT event_id, site_id, production_kwh, status FROM readings WHERE technology = 'wind'""")

ORACLE["daily_kpis_calendar"] = _q(*SILVER_CHAIN, SITES, DAILY, body=f"""
SELECT *,
       {RATIO(f"{D4('total_production_mwh')} - {D4('prev_day_production_mwh')}", "prev_day_production_mwh", 100, 2)}
         AS day_over_day_change_pct,
       {R(f"AVG({D('total_production_mwh')}) OVER (PARTITION BY site_id, technology ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)", 4)}
         AS rolling_7d_avg_mwh,
       CAST(DENSE_RANK() OVER (PARTITION BY date, technology ORDER BY total_production_mwh DESC NULLS LAST) AS INTEGER)
         AS daily_rank_in_technology
FROM (SELECT d.*, p.total_production_mwh AS prev_day_production_mwh
      FROM daily d LEFT JOIN daily p
        ON p.site_id = d.site_id AND p.technology = d.technology AND p.date = d.date - 1) x""")

# drops overlap and arrive out of order; the result is the batch job's silver
ORACLE["stream_upsert"] = _q(READINGS, f"""
clean AS (
  SELECT "timestamp", site_id, technology, CASE WHEN production_kwh < 0 THEN NULL ELSE production_kwh END AS production_kwh,
         {_CLEAN_STATUS} AS status,
         CASE WHEN technology = 'wind' AND sensor_1 < 0 THEN NULL ELSE sensor_1 END AS m1,
         CASE WHEN technology = 'wind' THEN CAST(event_id * 37 % 360 AS DOUBLE) WHEN sensor_2 < 0 THEN NULL ELSE sensor_2 END AS m2
  FROM readings)""", body="""
SELECT "timestamp", site_id, technology, production_kwh, status, m1 AS sensor_metric_1, m2 AS sensor_metric_2,
       CAST("timestamp" AS DATE) AS date, CAST(hour("timestamp") AS INTEGER) AS hour
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "timestamp", site_id, technology
                                   ORDER BY production_kwh DESC NULLS LAST, status ASC NULLS LAST,
                                            m1 ASC NULLS LAST, m2 ASC NULLS LAST) AS rn
      FROM clean) d
WHERE rn = 1""")

ORACLE["bronze_time_travel"] = _q(*BRONZE, body="""
SELECT 'solar' AS kind, COUNT(*) AS rows_v0, CAST(2 AS BIGINT) AS versions FROM solar_raw
UNION ALL
SELECT 'wind', COUNT(*), CAST(2 AS BIGINT) FROM wind_raw""")

ORACLE["merge_upsert_pruned"] = ORACLE["merge_upsert"]
