"""Step 5: slot payloads and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyhealth.operators import slots as S
from skyhealth.operators.gaps import calendar
from skyhealth.plans.oracle import PD, with_ctes
from skyhealth.plans.q_rules import _aqi_case
from skyhealth.plans.registry import register
from skyhealth.schemas import POLLUTION_SLOTS_PAYLOAD, WEATHER_SLOTS_PAYLOAD
from skyhealth.sources import payloads as P
from skyhealth.sources.driver import (pollution_daily, pollution_slot_payloads,
                                      weather_slot_payloads)

EV = """ev AS (
  SELECT CAST(user_id % 10 AS INTEGER) AS site_id, event_id, event_type,
    CAST(ts AS DATE) AS date, CAST(ts AS DATE) - CAST(event_id % 6 AS INTEGER) AS run_date,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
ws AS (
  SELECT site_id, run_date, date, CAST(date - run_date AS INTEGER) AS horizon,
    k % 40 + 5 AS temp, k % 40 + 5 + event_id % 3 AS temp_max, k % 40 + 5 - event_id % 2 AS temp_min,
    k % 40 + 5 + 1 AS feels_like, k AS humidity, k % 20 + 1000 AS pressure,
    (k * 2.5) * 3.6 AS wind,
    COALESCE(CASE WHEN event_type <> 'error' THEN k * 3.75 END, k * 2.5) * 3.6 AS wind_gust,
    k % 100 AS cloud,
    COALESCE(CASE WHEN event_type = 'purchase' THEN (k % 8) * 0.25 END, 0.0) AS rain_3h
  FROM ev),
ps AS (
  SELECT site_id, run_date, date, CAST(date - run_date AS INTEGER) AS horizon,
    CASE WHEN event_type <> 'signup' THEN k END AS pm25, k + 5 AS pm10, k * 2 AS ozone,
    k % 30 AS nitrogen_dioxide, k % 7 AS sulphur_dioxide
  FROM ev)"""

WDAILY = """wfd AS (
  SELECT *, round_even(temp_max + 0.33 * humidity_max - 0.70 * wind, 4) AS apparent_temp_max FROM (
    SELECT site_id, run_date, date, horizon,
      round_even(avg(temp), 4) AS temperature, round_even(max(temp_max), 4) AS temp_max,
      round_even(min(temp_min), 4) AS temp_min, round_even(avg(humidity), 4) AS humidity,
      round_even(max(humidity), 4) AS humidity_max, round_even(min(humidity), 4) AS humidity_min,
      round_even(avg(wind), 4) AS wind, round_even(max(wind), 4) AS wind_max,
      round_even(max(wind_gust), 4) AS wind_gust_max, round_even(avg(pressure), 4) AS pressure,
      round_even(avg(cloud), 4) AS cloud_cover, round_even(sum(rain_3h), 4) AS precipitation
    FROM ws WHERE horizon BETWEEN 1 AND 3 GROUP BY site_id, run_date, date, horizon) t)"""

PDAILY = f"""pfd AS (
  SELECT *, COALESCE({_aqi_case('pm25')}, 90) AS aqi FROM (
    SELECT site_id, run_date, date, horizon,
      round_even(avg(pm25), 4) AS pm25, round_even(avg(pm10), 4) AS pm10,
      round_even(avg(ozone), 4) AS ozone, round_even(avg(nitrogen_dioxide), 4) AS nitrogen_dioxide,
      round_even(avg(sulphur_dioxide), 4) AS sulphur_dioxide
    FROM ps WHERE horizon BETWEEN 1 AND 3 GROUP BY site_id, run_date, date, horizon) t)"""

SLOT_CHAIN = [EV, WDAILY, PDAILY]


def weather_slot_rows(spark, sf_dir):
    docs = P.parse_json_column(weather_slot_payloads(spark, sf_dir), "payload",
                               WEATHER_SLOTS_PAYLOAD)
    return P.explode_weather_slots(docs)


def pollution_slot_rows(spark, sf_dir):
    docs = P.parse_json_column(pollution_slot_payloads(spark, sf_dir), "payload",
                               POLLUTION_SLOTS_PAYLOAD)
    return P.explode_pollution_slots(docs)


def weather_forecast_daily(spark, sf_dir):
    return S.weather_slots_to_daily(S.forecast_window(weather_slot_rows(spark, sf_dir)))


def pollution_forecast_daily(spark, sf_dir):
    return S.pollution_slots_to_daily(S.forecast_window(pollution_slot_rows(spark, sf_dir)))


@register("weather_slots_daily", with_ctes(SLOT_CHAIN, "SELECT * FROM wfd"))
def weather_slots_daily(spark, sf_dir):
    return weather_forecast_daily(spark, sf_dir)


@register("pollution_slots_daily", with_ctes(SLOT_CHAIN, "SELECT * FROM pfd"))
def pollution_slots_daily(spark, sf_dir):
    return pollution_forecast_daily(spark, sf_dir)


@register("today_slot_stats", with_ctes(SLOT_CHAIN, """
SELECT site_id, run_date, max(temp) AS temp_max, min(temp) AS temp_min,
  max(humidity) AS humidity_max, min(humidity) AS humidity_min, max(wind) AS wind_max,
  max(wind_gust) AS wind_gust_max, max(feels_like) AS apparent_temp_max,
  min(feels_like) AS apparent_temp_min, round_even(avg(feels_like), 4) AS apparent_temp_mean,
  sum(rain_3h) AS precipitation, COUNT(*) AS n_slots
FROM ws WHERE date = run_date GROUP BY site_id, run_date"""))
def today_slot_stats(spark, sf_dir):
    return S.today_stats(weather_slot_rows(spark, sf_dir))


@register("latest_payload_per_day", with_ctes([PD], """
SELECT c.site_id, c.as_of, r.date AS file_date, r.aqi, r.pm25
FROM (SELECT site_id, CAST(unnest(generate_series(mn, mx, INTERVAL 1 DAY)) AS DATE) AS as_of
      FROM (SELECT site_id, MIN(date) AS mn, MAX(date) AS mx FROM pd GROUP BY site_id) b) c
ASOF JOIN pd r ON c.site_id = r.site_id AND c.as_of >= r.date"""))
def latest_payload_per_day(spark, sf_dir):
    recs = pollution_daily(spark, sf_dir).select("site_id", "date", "aqi", "pm25")
    bounds = recs.groupBy("site_id").agg(F.min("date").alias("mn"), F.max("date").alias("mx"))
    cal = bounds.select("site_id", calendar(F.col("mn"), F.col("mx")).alias("as_of"))
    return P.latest_record_asof(recs, cal, ["site_id"])
