"""Reusable Column expressions.

Sums and averages are taken over wide decimals: a double sum depends on the
order rows arrive in, which changes with partitioning, so rounded KPIs would
differ between two runs on a cluster. Summing ``decimal(38, 12)`` values is
order independent and keeps the readings' own digits; the only rounding is
that of the final value, which is cast back to double. A NaN or infinite
reading is no measurement: it has no decimal and counts as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from kilowatt import constants as K

__all__ = [
    "col_", "exact", "exact_sum", "exact_avg", "round_double", "null_if_negative",
    "standardise_status", "solar_efficiency_pct", "capacity_factor_pct",
    "availability_pct", "count_when", "day_over_day_pct", "zscore", "alert_level",
    "safe_double", "order_key", "common_prefix_len",
]

DEFAULT_SCALE = 12


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(c, scale: int = DEFAULT_SCALE) -> Column:
    """A double as ``decimal(38, scale)``; NULL where it is NaN or infinite."""
    return col_(c).try_cast(f"decimal(38,{scale})")


def exact_sum(c, scale: int = DEFAULT_SCALE) -> Column:
    return F.sum(exact(c, scale))


def exact_avg(c, scale: int = DEFAULT_SCALE) -> Column:
    return F.avg(exact(c, scale))


def round_double(c, digits: int) -> Column:
    """HALF_UP round, returned as double (decimal inputs round exactly)."""
    return F.round(col_(c), digits).cast("double")


def safe_double(c) -> Column:
    """String/number → double; malformed text becomes NULL instead of failing
    the job under ANSI mode."""
    return F.col(c).try_cast("double") if isinstance(c, str) else c.try_cast("double")


def null_if_negative(c) -> Column:
    """Negative reading → NULL (NULL stays NULL)."""
    c = col_(c)
    return F.when(c < 0, F.lit(None)).otherwise(c)


def standardise_status(c="status", valid=K.VALID_STATUSES, other=K.UNKNOWN_STATUS) -> Column:
    """Whitelisted status kept, anything else (NULL included) → ``other``."""
    c = col_(c)
    return F.when(c.isin(*valid), c).otherwise(F.lit(other))


def solar_efficiency_pct(kwh="production_kwh", irradiance="irradiance_w_m2") -> Column:
    """round(kwh / (irradiance × 0.01), 2) when irradiance > 0 and kwh known; the
    guard is on the divisor itself, so no irradiance is too small for it."""
    kwh, by = col_(kwh), col_(irradiance) * F.lit(0.01)
    return F.when((by > 0) & kwh.isNotNull(), F.round(kwh / by, 2)).otherwise(F.lit(None).cast("double"))


def capacity_factor_pct(kwh, capacity_mw, hours: int = 1, digits: int = 2) -> Column:
    """round(kwh / (capacity_mw × 1000 × hours) × 100, digits); NULL unless
    capacity > 0 (guards divide-by-zero, which raises under ANSI)."""
    kwh, cap = col_(kwh), col_(capacity_mw)
    denom = cap * 1000 if hours == 1 else cap * 1000 * hours
    return (F.when(cap > 0, F.round(kwh / denom * 100, digits))
            .otherwise(F.lit(None).cast("double")))


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as bigint (NULL cond counts 0)."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def availability_pct(status="status", offline=K.OFFLINE, digits: int = 1) -> Column:
    """round(#rows whose status != OFFLINE × 100.0 / #rows, 1) as double.
    (A NULL status is not counted available, as ``!=`` is NULL-unaware.)"""
    s = col_(status)
    up = F.sum(F.when(s != F.lit(offline), 1).otherwise(0)).cast("decimal(20,0)")
    return F.round(up * 100 / F.count(F.lit(1)).cast("decimal(20,0)"), digits).cast("double")


def day_over_day_pct(cur, prev, digits: int = 2) -> Column:
    """round((cur − prev) / nullif(prev, 0) × 100, 2), exact on values that have
    four decimals, as the daily totals do."""
    c, p = (col_(x).try_cast("decimal(18,4)") for x in (cur, prev))
    return F.round((c - p) / F.nullif(p, F.lit(0)) * 100, digits).cast("double")


def zscore(x, mean, std, digits: int = 2) -> Column:
    """round((x − mean) / nullif(std, 0), 2) — NULL when std is 0 or NULL."""
    return F.round((col_(x) - col_(mean)) / F.nullif(col_(std), F.lit(0.0)), digits)


def alert_level(z="z_score") -> Column:
    """Band label for a z-score; first matching band wins."""
    z = col_(z)
    return (F.when(z < K.ALERT_LOW_Z, K.ALERT_LOW)
            .when(z < K.ALERT_WEAK_Z, K.ALERT_WEAK)
            .when(z > K.ALERT_HIGH_Z, K.ALERT_HIGH)
            .otherwise(K.ALERT_NORMAL))


def common_prefix_len(df: DataFrame, c: str) -> int:
    """Length of the prefix shared by every non-NULL string of ``c``: every
    string between the minimum and the maximum shares their common prefix
    (one global min/max aggregate)."""
    row = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    lo, hi = (row["lo"], row["hi"]) if row is not None else (None, None)
    if lo is None or hi is None:
        return 0
    n = 0
    for a, b in zip(lo, hi):
        if a != b:
            break
        n += 1
    return n


def order_key(df: DataFrame, c: str, skip: int = 0) -> Column:
    """A double that never decreases when ``c`` increases in Spark's order, so
    range bucketing on it never splits equal values: numbers as themselves,
    dates / timestamps as epoch numbers, strings by 6 characters after the
    first ``skip`` ones (pass :func:`common_prefix_len` so ids such as
    ``SITE-000123`` are told apart; strings sharing those characters share a
    range, and the exact order inside a range comes from sorting the column)."""
    t = df.schema[c].dataType
    col = F.col(c)
    if isinstance(t, NumericType):
        return col.cast("double")
    if isinstance(t, DateType):
        return F.unix_date(col).cast("double")
    if isinstance(t, TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(t, TimestampNTZType):  # wall clock read as UTC: same order, any session zone
        return (F.unix_date(F.to_date(col)).cast("double") * 86_400_000_000.0
                + (F.hour(col) * 3600 + F.minute(col) * 60).cast("double") * 1_000_000.0
                + F.second(col).cast("double") * 1_000_000.0
                + (F.date_part(F.lit("SECOND"), col) * 1_000_000 % 1_000_000).cast("double"))
    if isinstance(t, StringType):
        # 6 characters × 8 bits = 48 bits, exact in a double; characters above
        # 255 clip to 255, which keeps the key monotone
        code = F.lit(0.0)
        for i in range(skip + 1, skip + 7):
            ch = F.coalesce(F.ascii(F.substring(col, i, 1)), F.lit(0)).cast("double")
            code = code * 256.0 + F.least(ch, F.lit(255.0))
        return F.when(col.isNull(), F.lit(None).cast("double")).otherwise(code)
    raise TypeError(f"no order key for column {c} of type {t}")
