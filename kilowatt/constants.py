"""Fixed values that must equal the reference's for identical results.

FIXED VALUES — do not change: status whitelist and fallback, technology names,
audit-column prefix, alert labels (in band order) and their z thresholds,
expected hours per full site-day.
"""

# FIXED VALUES (status cleaning)
VALID_STATUSES = ("OK", "DEGRADED", "OFFLINE")
UNKNOWN_STATUS = "UNKNOWN"
OFFLINE = "OFFLINE"

# FIXED VALUES (technologies, CHECK constraint domain)
TECHNOLOGIES = ("solar", "wind")

# FIXED VALUES (bronze audit columns are the ones with this prefix)
AUDIT_PREFIX = "_"

# FIXED VALUES (anomaly labels, first matching band wins; filter threshold)
ALERT_LOW = "🔴 ANOMALIE BASSE"            # z < -2
ALERT_WEAK = "🟡 Production faible"        # z < -1
ALERT_HIGH = "🔵 Production exceptionnelle"  # z > 2
ALERT_NORMAL = "✅ Normal"                  # otherwise
NO_BASELINE = "no baseline"              # drift alert of a site without history (ours)
ALERT_LOW_Z = -2.0
ALERT_WEAK_Z = -1.0
ALERT_HIGH_Z = 2.0
ANOMALY_ABS_Z = 1.5

# FIXED VALUES (hours in a full site-day, used by the daily capacity factor)
HOURS_PER_DAY = 24

# Common silver column order (unified fact table)
SILVER_COLUMNS = ["timestamp", "site_id", "technology", "production_kwh", "status",
                  "sensor_metric_1", "sensor_metric_2", "date", "hour",
                  "is_production", "efficiency_pct"]
SITE_COLUMNS = ["site_name", "region", "capacity_mw", "latitude", "longitude"]
