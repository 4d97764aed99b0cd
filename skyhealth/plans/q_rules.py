"""Step 4: rule variants and AQI."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyhealth.functions.aqi import (aqi_band_colour, aqi_band_name, mapping_lookup,
                                     pm25_to_us_aqi, severity)
from skyhealth.functions.constants import CATEGORY_COLOURS, RECOMMENDATIONS
from skyhealth.functions.features import add_features_v1, live_features
from skyhealth.functions.rules import classify
from skyhealth.plans.daily import gold_features, join_daily
from skyhealth.plans.oracle import GOLD_CHAIN, JOINED, PD, WD, live_case, v1_case, with_ctes
from skyhealth.plans.registry import register
from skyhealth.sources.driver import pollution_daily, weather_daily


def _aqi_case(x: str) -> str:
    bands = [(0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150),
             (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 350.4, 301, 400),
             (350.5, 500.4, 401, 500)]
    whens = " ".join(
        f"WHEN {x} >= {lo} AND {x} <= {hi} THEN (CAST({ah - al} AS DOUBLE) / CAST({hi - lo!r} AS DOUBLE)) "
        f"* ({x} - CAST({lo!r} AS DOUBLE)) + CAST({al} AS DOUBLE)"
        for lo, hi, al, ah in bands)
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE CAST(round_even(CASE {whens} ELSE 500.0 END, 0) "
            f"AS INTEGER) END")


@register("aqi_from_pm25", with_ctes([PD], f"""
SELECT site_id, date, pm25, pm25 * 4 AS pm25_x4, {_aqi_case('pm25')} AS aqi_us,
  {_aqi_case('pm25 * 4')} AS aqi_us_x4 FROM pd"""))
def aqi_from_pm25(spark, sf_dir):
    p = pollution_daily(spark, sf_dir)
    return p.select("site_id", "date", "pm25", (F.col("pm25") * 4).alias("pm25_x4"),
                    pm25_to_us_aqi(F.col("pm25")).alias("aqi_us"),
                    pm25_to_us_aqi(F.col("pm25") * 4).alias("aqi_us_x4"))


V1_FEAT = """v1 AS (
  SELECT site_id, date, aqi, pm25, ozone, nitrogen_dioxide,
    temperature + 0.33 * humidity - 0.70 * wind AS heat_index FROM joined)"""


@register("health_category_v1", with_ctes([WD, PD, JOINED, V1_FEAT], f"""
SELECT site_id, date, heat_index, {v1_case()} AS health_category FROM v1"""))
def health_category_v1(spark, sf_dir):
    j = add_features_v1(join_daily(weather_daily(spark, sf_dir), pollution_daily(spark, sf_dir)))
    return classify(j, "v1").select("site_id", "date", "heat_index", "health_category")


@register("health_category_live", with_ctes(GOLD_CHAIN, f"""
SELECT site_id, date, {live_case()} AS health_category FROM gold"""))
def health_category_live(spark, sf_dir):
    g = gold_features(spark, sf_dir)
    return classify(g, "live").select("site_id", "date", "health_category")


def _or(x, d):
    return f"(CASE WHEN {x} IS NOT NULL AND {x} <> 0 THEN {x} ELSE {d} END)"


LIVE_SQL = f"""lv0 AS (SELECT * FROM joined WHERE dayofmonth(date) = 1),
lv1 AS (SELECT *, {_or('temperature', '0.0')} AS t, {_or('humidity', '0.0')} AS h,
          {_or('wind', '0.0')} AS w, {_or('precipitation', '0.0')} AS pr,
          {_or('pm25', '0.0')} AS p25, {_or('pm10', '0.0')} AS p10, {_or('aqi', '0.0')} AS aq,
          {_or('nitrogen_dioxide', '0.0')} AS no2, {_or('sulphur_dioxide', '0.0')} AS so2,
          {_or('ozone', '0.0')} AS oz FROM lv0),
lv2 AS (SELECT *, {_or('temp_max', 't')} AS tmax, {_or('temp_min', 't')} AS tmin,
          {_or('humidity_min', 'h')} AS hmin, {_or('wind_max', 'w')} AS wmax,
          t + 0.33 * h - 0.70 * w AS hi FROM lv1),
lv3 AS (SELECT *, {_or('apparent_temp_max', 'hi')} AS app FROM lv2),
live AS (SELECT site_id, date,
  round_even(t, 4) AS temperature, round_even(h, 4) AS humidity, round_even(w, 4) AS wind,
  pressure, cloud_cover,
  round_even(CASE WHEN tmax IS NOT NULL AND tmax <> 0 THEN tmax END, 4) AS temp_max,
  round_even(CASE WHEN tmin IS NOT NULL AND tmin <> 0 THEN tmin END, 4) AS temp_min,
  round_even(tmax - tmin, 4) AS temp_range,
  round_even(app, 4) AS apparent_temp_max, apparent_temp_min, apparent_temp_mean, humidity_max,
  round_even(CASE WHEN hmin IS NOT NULL AND hmin <> 0 THEN hmin END, 4) AS humidity_min,
  round_even(CASE WHEN wmax IS NOT NULL AND wmax <> 0 THEN wmax END, 4) AS wind_max,
  wind_gust_max, round_even(pr, 4) AS precipitation,
  p25 AS pm25, CASE WHEN p10 <> 0 THEN p10 END AS pm10, aq AS aqi,
  CASE WHEN oz <> 0 THEN oz END AS ozone, CASE WHEN no2 <> 0 THEN no2 END AS nitrogen_dioxide,
  CASE WHEN so2 <> 0 THEN so2 END AS sulphur_dioxide,
  round_even(hi, 4) AS heat_index,
  round_even(p25 * 0.5 + p10 * 0.3 + aq * 0.2, 4) AS pollution_level,
  round_even(p25 * 0.4 + oz * 0.3 + no2 * 0.2 + so2 * 0.1, 4) AS respiratory_stress,
  CAST(0.0 AS DOUBLE) AS uv_risk, round_even(app, 4) AS heat_stress_peak,
  round_even(CASE WHEN hmin < 100 THEN wmax * (1 - hmin / 100) ELSE 0.0 END, 4) AS dust_risk_index,
  round_even(LEAST(pr, 20.0), 4) AS rain_wash_effect,
  'api_daily' AS source FROM lv3)"""


def live_rows(spark, sf_dir):
    """Landed live rows for the table-maintenance scenarios: the API record
    of the first day of each month plays "today's" row next to history."""
    j = join_daily(weather_daily(spark, sf_dir), pollution_daily(spark, sf_dir))
    return classify(live_features(j.where(F.dayofmonth("date") == 1)), "live")


LIVE_SQL_ALL_DAYS = LIVE_SQL.replace(" WHERE dayofmonth(date) = 1", "")


@register("live_features", with_ctes([WD, PD, JOINED, LIVE_SQL_ALL_DAYS],
                                     f"SELECT *, {live_case()} AS health_category FROM live"))
def live_features_q(spark, sf_dir):
    """F14 + F12 on every day's weather and air-quality record (whole table)."""
    j = join_daily(weather_daily(spark, sf_dir), pollution_daily(spark, sf_dir))
    return classify(live_features(j), "live")


AQI_SCALE_SQL = """CASE
  WHEN aqi >= 0 AND aqi <= 50 THEN '{n0}' WHEN aqi >= 51 AND aqi <= 100 THEN '{n1}'
  WHEN aqi >= 101 AND aqi <= 150 THEN '{n2}' WHEN aqi >= 151 AND aqi <= 200 THEN '{n3}'
  WHEN aqi >= 201 AND aqi <= 300 THEN '{n4}' WHEN aqi >= 301 AND aqi <= 500 THEN '{n5}'
  ELSE '{d}' END"""
BAND_NAME_SQL = AQI_SCALE_SQL.format(n0="Good", n1="Moderate", n2="Unhealthy for Sensitive",
                                     n3="Unhealthy", n4="Very Unhealthy", n5="Hazardous",
                                     d="Unknown")
BAND_COLOUR_SQL = AQI_SCALE_SQL.format(n0="#2ecc71", n1="#f1c40f", n2="#e67e22", n3="#e74c3c",
                                       n4="#8e44ad", n5="#7b241c", d="#95a5a6")


@register("aqi_band_counts", with_ctes(GOLD_CHAIN, f"""
SELECT band, colour, COUNT(*) AS days FROM (
  SELECT {BAND_NAME_SQL} AS band, {BAND_COLOUR_SQL} AS colour FROM gold) t
GROUP BY band, colour"""))
def aqi_band_counts(spark, sf_dir):
    g = gold_features(spark, sf_dir)
    return (g.select(aqi_band_name(F.col("aqi")).alias("band"),
                     aqi_band_colour(F.col("aqi")).alias("colour"))
            .groupBy("band", "colour").agg(F.count(F.lit(1)).alias("days")))


@register("threshold_exceedance", with_ctes(GOLD_CHAIN, """
SELECT site_id, strftime(date, '%Y-%m') AS month, COUNT(*) AS days,
  COUNT(*) FILTER (WHERE aqi > 50) AS days_aqi_over_50,
  COUNT(*) FILTER (WHERE aqi > 100) AS days_aqi_over_100,
  COUNT(*) FILTER (WHERE pm25 > 15) AS days_pm25_over_15
FROM gold GROUP BY site_id, month"""))
def threshold_exceedance(spark, sf_dir):
    g = gold_features(spark, sf_dir)
    return (g.groupBy("site_id", F.date_format("date", "yyyy-MM").alias("month"))
            .agg(F.count(F.lit(1)).alias("days"),
                 F.count_if(F.col("aqi") > 50).alias("days_aqi_over_50"),
                 F.count_if(F.col("aqi") > 100).alias("days_aqi_over_100"),
                 F.count_if(F.col("pm25") > 15).alias("days_pm25_over_15")))


def _map_sql(col, mapping, default):
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    d = "NULL" if default is None else (f"'{default}'" if isinstance(default, str) else str(default))
    return f"CASE {whens} ELSE {d} END"


SEVERITY_SQL = ("CASE health_category WHEN 'Safe Air Day' THEN 5 WHEN 'Moderate Risk Day' THEN 4 "
                "WHEN 'High Respiratory Risk Day' THEN 3 WHEN 'Mask Recommended Day' THEN 2 "
                "WHEN 'Avoid Outdoor Activity Day' THEN 1 ELSE 6 END")


@register("category_advice", with_ctes(GOLD_CHAIN, f"""
SELECT site_id, date, health_category,
  {_map_sql('health_category', RECOMMENDATIONS, None)} AS recommendation,
  {_map_sql('health_category', CATEGORY_COLOURS, '#95a5a6')} AS colour,
  {SEVERITY_SQL} AS severity
FROM gold"""))
def category_advice(spark, sf_dir):
    g = gold_features(spark, sf_dir)
    cat = F.col("health_category")
    return g.select("site_id", "date", "health_category",
                    mapping_lookup(cat, RECOMMENDATIONS, None).alias("recommendation"),
                    mapping_lookup(cat, CATEGORY_COLOURS, "#95a5a6").alias("colour"),
                    severity(cat).alias("severity"))
