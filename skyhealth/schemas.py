"""Canonical column lists and explicit schemas.

Every scan uses an explicit schema; optional columns are added as typed NULL
(or a default) by :func:`skyhealth.functions.columns.ensure_columns`.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Column names, renames, keep lists, features and view columns of the data
# contract; all lists to the end of this module.
KEYS = ["site_id", "date"]

WEATHER_COLUMNS = [
    "temperature", "humidity", "wind", "pressure", "cloud_cover",
    "sunshine_duration",
    "temp_max", "temp_min",
    "apparent_temp_max", "apparent_temp_min", "apparent_temp_mean",
    "humidity_max", "humidity_min",
    "wind_max", "wind_gust_max",
    "precipitation", "rain_sum",
    "dew_point", "shortwave_radiation", "vapour_pressure_deficit",
]

POLLUTION_COLUMNS = [
    "pm25", "pm10", "aqi", "european_aqi",
    "ozone", "nitrogen_dioxide", "sulphur_dioxide",
    "dust", "uv_index", "carbon_monoxide", "aerosol_optical_depth",
]

FEATURE_COLUMNS = [
    "heat_index", "pollution_level", "respiratory_stress", "uv_risk",
    "temp_range", "heat_stress_peak", "dust_risk_index", "rain_wash_effect",
]

# Gold feature table: date, 20 weather, 11 pollution, 8 features, category,
# source (plus our site_id key in front).
GOLD_COLUMNS = (["site_id", "date"] + WEATHER_COLUMNS + POLLUTION_COLUMNS
                + FEATURE_COLUMNS + ["health_category", "source"])

# Raw -> canonical renames.
WEATHER_RENAMES = {
    "temperature_2m_mean": "temperature",
    "relative_humidity_2m_mean": "humidity",
    "wind_speed_10m_mean": "wind",
    "pressure_msl_mean": "pressure",
    "cloud_cover_mean": "cloud_cover",
    "sunshine_duration": "sunshine_duration",
    "temperature_2m_max": "temp_max",
    "temperature_2m_min": "temp_min",
    "apparent_temperature_max": "apparent_temp_max",
    "apparent_temperature_min": "apparent_temp_min",
    "apparent_temperature_mean": "apparent_temp_mean",
    "relative_humidity_2m_max": "humidity_max",
    "relative_humidity_2m_min": "humidity_min",
    "wind_speed_10m_max": "wind_max",
    "wind_gusts_10m_max": "wind_gust_max",
    "precipitation_sum": "precipitation",
    "rain_sum": "rain_sum",
    "dew_point_2m_mean": "dew_point",
    "shortwave_radiation_sum": "shortwave_radiation",
    "vapour_pressure_deficit_max": "vapour_pressure_deficit",
}
POLLUTION_RENAMES = {"pm2_5": "pm25", "us_aqi": "aqi"}

WEATHER_CRITICAL = ["date", "temperature", "humidity", "wind"]

# Base + optional model features (the optional four are used when present).
MODEL_FEATURES_BASE = [
    "temperature", "humidity", "wind", "heat_index",
    "pm25", "pm10", "aqi", "pollution_level",
    "respiratory_stress", "uv_risk",
    "pressure", "ozone", "nitrogen_dioxide",
]
MODEL_FEATURES_OPTIONAL = [
    "temp_range", "heat_stress_peak", "dust_risk_index", "rain_wash_effect",
]

# Forecast feature output order.
FORECAST_FEATURE_COLUMNS = [
    "site_id", "run_date", "date", "horizon",
    "temperature", "humidity", "wind", "pressure", "cloud_cover",
    "pm25", "pm10", "aqi", "ozone", "nitrogen_dioxide", "sulphur_dioxide",
    "heat_index", "pollution_level", "respiratory_stress", "uv_risk",
    "temp_range", "heat_stress_peak", "dust_risk_index", "rain_wash_effect",
]

# Latest-forecast view columns.
LATEST_FORECAST_COLUMNS = [
    "forecast_date", "forecast_horizon", "predicted_category", "confidence",
    "temp_range", "heat_stress_peak", "dust_risk_index", "rain_wash_effect",
    "prob_safe", "prob_moderate", "prob_high_resp", "prob_mask", "prob_avoid",
    "temperature", "humidity", "wind", "pm25", "aqi",
    "heat_index", "pollution_level", "respiratory_stress",
    "generated_at", "model_version",
]


def _doubles(names):
    return [T.StructField(n, T.DoubleType(), True) for n in names]


# Raw weather CSV: all measures double, date kept as string (tz suffix).
WEATHER_RAW_SCHEMA = T.StructType(
    [T.StructField("site_id", T.IntegerType(), True),
     T.StructField("date", T.StringType(), True)]
    + _doubles(list(WEATHER_RENAMES.keys())))

POLLUTION_RAW_SCHEMA = T.StructType(
    [T.StructField("site_id", T.IntegerType(), True),
     T.StructField("date", T.StringType(), True)]
    + _doubles(["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide",
                "sulphur_dioxide", "ozone", "aerosol_optical_depth", "dust",
                "uv_index", "us_aqi", "european_aqi"]))

# 3-hourly weather slots payload.
WEATHER_SLOT = T.StructType([
    T.StructField("dt", T.LongType(), True),
    T.StructField("main", T.StructType(_doubles(
        ["temp", "temp_max", "temp_min", "feels_like", "humidity", "pressure"])), True),
    T.StructField("wind", T.StructType(_doubles(["speed", "gust"])), True),
    T.StructField("clouds", T.StructType(_doubles(["all"])), True),
    T.StructField("rain", T.StructType(_doubles(["3h"])), True),
])
WEATHER_SLOTS_PAYLOAD = T.StructType([
    T.StructField("site_id", T.IntegerType(), True),
    T.StructField("run_date", T.DateType(), True),
    T.StructField("list", T.ArrayType(WEATHER_SLOT), True),
])

POLLUTION_SLOT = T.StructType([
    T.StructField("dt", T.LongType(), True),
    T.StructField("main", T.StructType([T.StructField("aqi", T.IntegerType(), True)]), True),
    T.StructField("components", T.StructType(_doubles(
        ["pm2_5", "pm10", "o3", "no2", "so2", "co"])), True),
])
POLLUTION_SLOTS_PAYLOAD = T.StructType([
    T.StructField("site_id", T.IntegerType(), True),
    T.StructField("run_date", T.DateType(), True),
    T.StructField("list", T.ArrayType(POLLUTION_SLOT), True),
])

HOURLY_VARIABLES = ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide",
                    "sulphur_dioxide", "ozone", "aerosol_optical_depth", "dust",
                    "uv_index", "us_aqi", "european_aqi"]
HOURLY_COLUMNAR_PAYLOAD = T.StructType([
    T.StructField("site_id", T.IntegerType(), True),
    T.StructField("batch_seq", T.LongType(), True),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()), True)]
        + [T.StructField(v, T.ArrayType(T.DoubleType()), True) for v in HOURLY_VARIABLES]), True),
])
