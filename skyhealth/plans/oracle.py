"""Independent ANSI-SQL formulations of the registered queries (DuckDB dialect).

These are the correctness oracle: the same semantics written as plain SQL
over the raw driver tables, so that a DataFrame bug does not hide behind a
shared helper. CTE fragments are composed with :func:`with_ctes`.
"""

from __future__ import annotations


def avg_dec(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE)"


WD = f"""wd AS (
  SELECT site_id, date,
    q_avg AS temperature, d_avg * 1000 AS humidity, t_avg * 600 AS wind,
    ln_avg + 1000 AS pressure, p_avg / 1000 AS cloud_cover,
    q_max AS temp_max, q_min AS temp_min,
    q_avg * CAST(2 AS DOUBLE) AS apparent_temp_max, q_min * CAST(2 AS DOUBLE) AS apparent_temp_min,
    q_avg * CAST(1.5 AS DOUBLE) AS apparent_temp_mean,
    d_max * 1000 AS humidity_max, d_min * 1000 AS humidity_min,
    t_max * 600 AS wind_max, t_max * 900 AS wind_gust_max,
    CAST(n_r AS DOUBLE) * CAST(0.25 AS DOUBLE) AS precipitation,
    CAST(n_r AS DOUBLE) * CAST(0.2 AS DOUBLE) AS rain_sum
  FROM (
    SELECT CAST(l_orderkey % 4 AS INTEGER) AS site_id, CAST(l_shipdate AS DATE) AS date,
      {avg_dec('l_quantity')} AS q_avg, MAX(l_quantity) AS q_max, MIN(l_quantity) AS q_min,
      {avg_dec('l_discount')} AS d_avg, MIN(l_discount) AS d_min, MAX(l_discount) AS d_max,
      {avg_dec('l_tax')} AS t_avg, MAX(l_tax) AS t_max,
      SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_r,
      {avg_dec('l_linenumber')} AS ln_avg, {avg_dec('l_extendedprice')} AS p_avg
    FROM lineitem GROUP BY 1, 2) g)"""

PD = f"""pd AS (
  SELECT site_id, date,
    p_avg / 10000 AS pm25, p_max / 10000 AS pm10, p_avg / 2500 AS aqi,
    p_avg / 3000 AS european_aqi, p_min / 1000 AS ozone, p_avg / 8000 AS nitrogen_dioxide,
    p_min / 50000 AS sulphur_dioxide, p_max / 2480 AS dust,
    CAST(c_max % 12 AS DOUBLE) AS uv_index, p_avg / 1000 AS carbon_monoxide,
    CAST(n AS DOUBLE) / CAST(40.0 AS DOUBLE) AS aerosol_optical_depth
  FROM (
    SELECT CAST(o_orderkey % 4 AS INTEGER) AS site_id, CAST(o_orderdate AS DATE) AS date,
      {avg_dec('o_totalprice')} AS p_avg, MAX(o_totalprice) AS p_max, MIN(o_totalprice) AS p_min,
      COUNT(*) AS n, MAX(o_custkey) AS c_max
    FROM orders GROUP BY 1, 2) g)"""

WEATHER_COLS = ("temperature, humidity, wind, pressure, cloud_cover, "
                "CAST(NULL AS DOUBLE) AS sunshine_duration, temp_max, temp_min, "
                "apparent_temp_max, apparent_temp_min, apparent_temp_mean, humidity_max, "
                "humidity_min, wind_max, wind_gust_max, precipitation, rain_sum, "
                "CAST(NULL AS DOUBLE) AS dew_point, CAST(NULL AS DOUBLE) AS shortwave_radiation, "
                "CAST(NULL AS DOUBLE) AS vapour_pressure_deficit")
POLLUTION_COLS = ("pm25, pm10, aqi, european_aqi, ozone, nitrogen_dioxide, sulphur_dioxide, "
                  "dust, uv_index, carbon_monoxide, aerosol_optical_depth")

FEATURES_SQL = """
    COALESCE(temperature, 0) + 0.33 * COALESCE(humidity, 0) - 0.70 * COALESCE(wind, 0) AS heat_index,
    COALESCE(pm25, 0) * 0.5 + COALESCE(pm10, 0) * 0.3 + COALESCE(aqi, 0) * 0.2 AS pollution_level,
    COALESCE(pm25, 0) * 0.4 + COALESCE(ozone, 0) * 0.3 + COALESCE(nitrogen_dioxide, 0) * 0.2
      + COALESCE(sulphur_dioxide, 0) * 0.1 AS respiratory_stress,
    LEAST(GREATEST(COALESCE(uv_index, 0) / 11 * 100, 0), 100) AS uv_risk,
    COALESCE(temp_max, 0) - COALESCE(temp_min, 0) AS temp_range,
    COALESCE(apparent_temp_max, 0) AS heat_stress_peak,
    COALESCE(wind_max, 0) * (1 - COALESCE(humidity_min, 0) / 100) AS dust_risk_index,
    LEAST(GREATEST(COALESCE(precipitation, 0), 0), 20) AS rain_wash_effect"""


def v21_case(p: str = "") -> str:
    """v2.1 classifier over columns (optionally prefixed)."""
    c = lambda n: f"COALESCE(NULLIF({p}{n}, 0), 0)"
    rf = f"GREATEST(0.5, 1 - {c('rain_wash_effect')} * 0.05)"
    ea = f"({c('aqi')} * {rf})"
    ep = f"({c('pm25')} * {rf})"
    hm = f"COALESCE(NULLIF({p}humidity_min, 0), 50)"
    return f"""CASE
      WHEN ({c('wind_max')} > 40 AND {hm} < 20 AND {c('dust_risk_index')} > 25)
        OR {c('dust')} > 200 OR ({c('aerosol_optical_depth')} > 0.55 AND {c('wind_max')} > 35)
        THEN 'Avoid Outdoor Activity Day'
      WHEN {ea} > 150 OR {ep} > 65 THEN 'Avoid Outdoor Activity Day'
      WHEN {ea} > 120 OR {ep} > 50 OR {c('heat_stress_peak')} > 54 THEN 'Mask Recommended Day'
      WHEN {ea} > 90 OR {ep} > 35 OR {c('ozone')} > 100 OR {c('dust_risk_index')} > 30
        OR {c('aerosol_optical_depth')} > 0.40 THEN 'High Respiratory Risk Day'
      WHEN {ea} > 50 OR {ep} > 12 OR {c('nitrogen_dioxide')} > 40 THEN 'Moderate Risk Day'
      ELSE 'Safe Air Day' END"""


def v1_case(p: str = "") -> str:
    c = lambda n: f"COALESCE(NULLIF({p}{n}, 0), 0)"
    return f"""CASE
      WHEN {c('aqi')} > 110 OR {c('pm25')} > 50 THEN 'Avoid Outdoor Activity Day'
      WHEN {c('aqi')} > 85 OR {c('pm25')} > 30 OR {c('heat_index')} > 48 THEN 'Mask Recommended Day'
      WHEN {c('aqi')} > 70 OR {c('pm25')} > 20 OR {c('ozone')} > 80 THEN 'High Respiratory Risk Day'
      WHEN {c('aqi')} > 55 OR {c('pm25')} > 14 OR {c('nitrogen_dioxide')} > 30 THEN 'Moderate Risk Day'
      ELSE 'Safe Air Day' END"""


def live_case(p: str = "") -> str:
    c = lambda n: f"COALESCE(NULLIF({p}{n}, 0), 0)"
    rf = f"GREATEST(0.5, 1 - {c('rain_wash_effect')} * 0.05)"
    ea = f"({c('aqi')} * {rf})"
    ep = f"({c('pm25')} * {rf})"
    return f"""CASE
      WHEN {ea} > 150 OR {ep} > 65 THEN 'Avoid Outdoor Activity Day'
      WHEN {ea} > 120 OR {ep} > 50 THEN 'Mask Recommended Day'
      WHEN {ea} > 90 OR {ep} > 35 THEN 'High Respiratory Risk Day'
      WHEN {ea} > 50 OR {ep} > 12 THEN 'Moderate Risk Day'
      ELSE 'Safe Air Day' END"""


JOINED = f"""joined AS (
  SELECT wd.site_id, wd.date, {WEATHER_COLS}, {POLLUTION_COLS}
  FROM wd JOIN pd ON wd.site_id = pd.site_id AND wd.date = pd.date)"""

FEAT = f"""feat AS (SELECT *, {FEATURES_SQL} FROM joined)"""

GOLD_COLS = ("site_id, date, temperature, humidity, wind, pressure, cloud_cover, sunshine_duration, "
             "temp_max, temp_min, apparent_temp_max, apparent_temp_min, apparent_temp_mean, "
             "humidity_max, humidity_min, wind_max, wind_gust_max, precipitation, rain_sum, "
             "dew_point, shortwave_radiation, vapour_pressure_deficit, "
             "pm25, pm10, aqi, european_aqi, ozone, nitrogen_dioxide, sulphur_dioxide, dust, "
             "uv_index, carbon_monoxide, aerosol_optical_depth, "
             "heat_index, pollution_level, respiratory_stress, uv_risk, temp_range, "
             "heat_stress_peak, dust_risk_index, rain_wash_effect, health_category, source")

GOLD = f"""gold AS (
  SELECT * EXCLUDE (hc), hc AS health_category, CAST(NULL AS VARCHAR) AS source FROM (
    SELECT *, {v21_case()} AS hc FROM feat) x)"""

GOLD_CHAIN = [WD, PD, JOINED, FEAT, GOLD]


def with_ctes(ctes, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
