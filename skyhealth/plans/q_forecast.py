"""Step 6: forecast features."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyhealth.plans.forecast import WEATHER_DAY, engineer, land_and_reload
from skyhealth.plans.oracle import with_ctes
from skyhealth.plans.q_slots import SLOT_CHAIN, pollution_forecast_daily, weather_forecast_daily
from skyhealth.plans.registry import register

FFEAT = """fj AS (
  SELECT w.*, p.pm25, p.pm10, p.aqi, p.ozone, p.nitrogen_dioxide, p.sulphur_dioxide
  FROM wfd w JOIN pfd p ON w.site_id = p.site_id AND w.run_date = p.run_date
    AND w.date = p.date AND w.horizon = p.horizon),
ff AS (
  SELECT site_id, run_date, date, horizon, temperature, humidity, wind, pressure, cloud_cover,
    COALESCE(pm25, 35.0) AS pm25, COALESCE(pm10, 55.0) AS pm10, CAST(COALESCE(aqi, 90.0) AS DOUBLE) AS aqi,
    COALESCE(ozone, 60.0) AS ozone, COALESCE(nitrogen_dioxide, 25.0) AS nitrogen_dioxide,
    COALESCE(sulphur_dioxide, 5.0) AS sulphur_dioxide,
    COALESCE(temp_max, MAX(temperature) OVER (PARTITION BY site_id, run_date)) AS temp_max,
    COALESCE(temp_min, MIN(temperature) OVER (PARTITION BY site_id, run_date)) AS temp_min,
    COALESCE(humidity_min, 30.0) AS humidity_min,
    COALESCE(wind_max, MAX(wind) OVER (PARTITION BY site_id, run_date)) AS wind_max,
    COALESCE(apparent_temp_max, 38.0) AS apparent_temp_max,
    COALESCE(precipitation, 0.0) AS precipitation
  FROM fj),
fout AS (
  SELECT site_id, run_date, date, horizon, temperature, humidity, wind, pressure, cloud_cover,
    pm25, pm10, aqi, ozone, nitrogen_dioxide, sulphur_dioxide,
    temperature + 0.33 * humidity - 0.70 * wind AS heat_index,
    pm25 * 0.5 + pm10 * 0.3 + aqi * 0.2 AS pollution_level,
    pm25 * 0.4 + ozone * 0.3 + nitrogen_dioxide * 0.2 + sulphur_dioxide * 0.1 AS respiratory_stress,
    CAST(0.0 AS DOUBLE) AS uv_risk, temp_max - temp_min AS temp_range,
    apparent_temp_max AS heat_stress_peak,
    wind_max * (1 - humidity_min / 100) AS dust_risk_index,
    LEAST(GREATEST(precipitation, 0), 20) AS rain_wash_effect
  FROM ff)"""

FORECAST_CHAIN = SLOT_CHAIN + [FFEAT]


def forecast_features_df(spark, sf_dir):
    weather = land_and_reload(weather_forecast_daily(spark, sf_dir),
                              F.date_format("run_date", "yyyy-MM-dd'T'00:00:00'Z'"), WEATHER_DAY)
    weather = weather.drop("fetched_at", "source")
    return engineer(weather, pollution_forecast_daily(spark, sf_dir))


@register("forecast_features", with_ctes(FORECAST_CHAIN, "SELECT * FROM fout"))
def forecast_features(spark, sf_dir):
    return forecast_features_df(spark, sf_dir)
