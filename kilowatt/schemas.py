"""Declared schemas of the landing files (explicit schemas avoid the extra
inference scan over the whole input)."""

from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                               StructType, TimestampType)

SOLAR_SCHEMA = StructType([
    StructField("timestamp", TimestampType(), False),
    StructField("site_id", StringType(), False),
    StructField("panel_temp_c", DoubleType(), True),
    StructField("irradiance_w_m2", DoubleType(), True),
    StructField("production_kwh", DoubleType(), True),
    StructField("status", StringType(), True),
])

WIND_SCHEMA = StructType([
    StructField("timestamp", TimestampType(), False),
    StructField("site_id", StringType(), False),
    StructField("wind_speed_ms", DoubleType(), True),
    StructField("wind_direction_deg", IntegerType(), True),
    StructField("production_kwh", DoubleType(), True),
    StructField("status", StringType(), True),
])

SITES_SCHEMA = StructType([
    StructField("site_id", StringType(), False),
    StructField("site_name", StringType(), True),
    StructField("region", StringType(), True),
    StructField("capacity_mw", DoubleType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
])
