"""Step 10: marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skyhealth.functions.aqi import mapping_lookup
from skyhealth.functions.constants import FORECAST_ADVICE, FORECAST_ADVICE_DEFAULT
from skyhealth.operators.gaps import keep_last
from skyhealth.plans import marts as MT
from skyhealth.plans.daily import gold_features
from skyhealth.plans.oracle import GOLD_CHAIN, JOINED, PD, WD, v1_case, with_ctes
from skyhealth.plans.q_merge import FLOG, LIVE_GOLD
from skyhealth.plans.q_rules import LIVE_SQL, V1_FEAT, _map_sql, health_category_v1, live_rows
from skyhealth.plans.q_windows import LATEST, latest_forecast_df
from skyhealth.plans.registry import register
from skyhealth.sources.driver import forecast_log
from skyhealth.sources.tables import run_query

WEEK = "CAST(date_trunc('week', forecast_date) AS DATE)"


def _week(df):
    return df.withColumn("week_start", F.date_trunc("week", F.col("forecast_date")).cast("date"))


@register("category_distribution", with_ctes(GOLD_CHAIN, """
SELECT s.site_id, c.health_category, COALESCE(n.days, 0) AS days,
  round_even(COALESCE(n.days, 0) / t.total * 100, 1) AS pct,
  t.safe_pct > 15.0 AS safe_share_warning
FROM (SELECT DISTINCT site_id FROM gold) s
JOIN (SELECT site_id, COUNT(*) AS total,
        COUNT(*) FILTER (WHERE health_category = 'Safe Air Day') / COUNT(*) * 100 AS safe_pct
      FROM gold GROUP BY site_id) t ON t.site_id = s.site_id
JOIN (SELECT unnest(['Safe Air Day', 'Moderate Risk Day', 'High Respiratory Risk Day',
        'Mask Recommended Day', 'Avoid Outdoor Activity Day']) AS health_category) c ON TRUE
LEFT JOIN (SELECT site_id, health_category, COUNT(*) AS days FROM gold GROUP BY 1, 2) n
  ON n.site_id = s.site_id AND n.health_category = c.health_category"""))
def category_distribution(spark, sf_dir):
    return MT.category_distribution(gold_features(spark, sf_dir))


@register("range_kpis", with_ctes(GOLD_CHAIN, """
SELECT site_id, round_even(round_even(AVG(aqi), 10), 6) AS avg_aqi, MAX(aqi) AS max_aqi,
  round_even(round_even(AVG(pm25), 10), 6) AS avg_pm25, MAX(pm25) AS max_pm25,
  round_even(round_even(AVG(temperature), 10), 6) AS avg_temperature, MAX(temperature) AS max_temperature,
  round_even(round_even(AVG(humidity), 10), 6) AS avg_humidity, COUNT(*) AS records
FROM gold WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' GROUP BY site_id"""))
def range_kpis(spark, sf_dir):
    return MT.range_kpis(gold_features(spark, sf_dir), "1996-01-01", "1997-12-31")


@register("range_rows_by_parameter", with_ctes(GOLD_CHAIN, """
SELECT site_id, health_category, COUNT(*) AS days, MAX(aqi) AS max_aqi FROM gold
WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' GROUP BY 1, 2"""))
def range_rows_by_parameter(spark, sf_dir):
    """The dates are bound as parameters."""
    return run_query(spark, """
        SELECT site_id, health_category, COUNT(*) AS days, MAX(aqi) AS max_aqi FROM {gold}
        WHERE date BETWEEN :first AND :last GROUP BY site_id, health_category""",
                     {"first": dt.date(1996, 1, 1), "last": dt.date(1997, 12, 31)}, gold=gold_features(spark, sf_dir))


@register("coverage", with_ctes(GOLD_CHAIN + [LIVE_SQL, LIVE_GOLD, FLOG], """
SELECT 'environmental_features' AS table_name, MIN(date) AS min_date, MAX(date) AS max_date,
  COUNT(*) AS row_count FROM (SELECT date FROM gold UNION ALL SELECT date FROM live_gold) t
UNION ALL SELECT 'risk_predictions', MIN(date), MAX(date), COUNT(*) FROM gold
UNION ALL SELECT 'forecast_predictions', MIN(forecast_date), MAX(forecast_date), COUNT(*) FROM flog"""))
def coverage(spark, sf_dir):
    hist = gold_features(spark, sf_dir)
    ef = hist.unionByName(live_rows(spark, sf_dir), allowMissingColumns=True)
    return MT.coverage({"environmental_features": ef, "risk_predictions": hist,
                        "forecast_predictions": forecast_log(spark, sf_dir)},
                       {"forecast_predictions": "forecast_date"})


@register("monthly_avg", with_ctes(GOLD_CHAIN, """
SELECT site_id, strftime(date, '%Y-%m') AS month, round_even(round_even(AVG(aqi), 10), 6) AS avg_aqi,
  round_even(round_even(AVG(pm25), 10), 6) AS avg_pm25 FROM gold GROUP BY 1, 2"""))
def monthly_avg(spark, sf_dir):
    return MT.monthly_avg(gold_features(spark, sf_dir))


@register("monthly_category_days", with_ctes(GOLD_CHAIN, """
SELECT site_id, strftime(date, '%Y-%m') AS month, health_category, COUNT(*) AS days
FROM gold GROUP BY 1, 2, 3"""))
def monthly_category_days(spark, sf_dir):
    return MT.monthly_category_days(gold_features(spark, sf_dir))


@register("forecast_by_horizon", with_ctes([FLOG, LATEST], f"""
SELECT {WEEK} AS week_start,
  round_even(round_even(AVG(CASE WHEN forecast_horizon = 1 THEN aqi END), 10), 6) AS avg_aqi_d1,
  round_even(round_even(AVG(CASE WHEN forecast_horizon = 2 THEN aqi END), 10), 6) AS avg_aqi_d2,
  round_even(round_even(AVG(CASE WHEN forecast_horizon = 3 THEN aqi END), 10), 6) AS avg_aqi_d3,
  round_even(round_even(AVG(CASE WHEN forecast_horizon = 1 THEN confidence END), 10), 6) AS avg_confidence_d1,
  round(round_even(AVG(CASE WHEN forecast_horizon = 1 THEN pm25 END), 10), 1) AS pm25_d1,
  round(round_even(AVG(CASE WHEN forecast_horizon = 1 THEN heat_index END), 10), 1) AS heat_index_d1
FROM latest GROUP BY 1"""))
def forecast_by_horizon(spark, sf_dir):
    return MT.by_horizon(_week(latest_forecast_df(spark, sf_dir)), ["week_start"])


def _sel(k):
    c = f"CASE WHEN forecast_horizon = {k} THEN predicted_category END"
    return (f"CASE WHEN COUNT(DISTINCT {c}) = 1 THEN MAX({c}) "
            f"ELSE 'No forecast available' END")


@register("selected_category", with_ctes([FLOG, LATEST], f"""
SELECT {WEEK} AS week_start, {_sel(1)} AS tomorrow_category, {_sel(2)} AS day2_category,
  {_sel(3)} AS day3_category FROM latest GROUP BY 1"""))
def selected_category(spark, sf_dir):
    return MT.selected_category(_week(latest_forecast_df(spark, sf_dir)), ["week_start"])


@register("worst_category", with_ctes([FLOG, LATEST], f"""
SELECT {WEEK} AS week_start, MIN(CASE predicted_category WHEN 'Safe Air Day' THEN 5
  WHEN 'Moderate Risk Day' THEN 4 WHEN 'High Respiratory Risk Day' THEN 3
  WHEN 'Mask Recommended Day' THEN 2 WHEN 'Avoid Outdoor Activity Day' THEN 1 ELSE 6 END)
  AS worst_severity FROM latest GROUP BY 1"""))
def worst_category(spark, sf_dir):
    return MT.worst_category(_week(latest_forecast_df(spark, sf_dir)), ["week_start"])


@register("days_until_safe", with_ctes([FLOG, LATEST], f"""
SELECT {WEEK} AS week_start,
  COALESCE('Day +' || CAST(MIN(CASE WHEN predicted_category = 'Safe Air Day' THEN forecast_horizon END) AS VARCHAR),
           'None in 3-day window') AS days_until_safe
FROM latest GROUP BY 1"""))
def days_until_safe(spark, sf_dir):
    return MT.days_until_safe(_week(latest_forecast_df(spark, sf_dir)), ["week_start"])


@register("last_n_days", with_ctes(GOLD_CHAIN, """
SELECT g.site_id, p.preset_days, COUNT(*) AS days, MIN(g.date) AS from_date, MAX(g.date) AS to_date,
  round_even(round_even(AVG(g.aqi), 10), 6) AS avg_aqi
FROM gold g JOIN (SELECT site_id, MAX(date) AS mx FROM gold GROUP BY site_id) m ON m.site_id = g.site_id
JOIN (SELECT unnest([7, 30, 90, 180, 365]) AS preset_days) p ON g.date >= m.mx - p.preset_days
GROUP BY g.site_id, p.preset_days"""))
def last_n_days(spark, sf_dir):
    return MT.relative_windows(gold_features(spark, sf_dir))


@register("trend_projection", with_ctes(GOLD_CHAIN, """
SELECT site_id, date, aqi, pm25, temperature, heat_index, ozone, respiratory_stress, health_category
FROM gold"""))
def trend_projection(spark, sf_dir):
    """the series behind the trend and scatter charts (sorted by date)."""
    return (gold_features(spark, sf_dir)
            .select("site_id", "date", "aqi", "pm25", "temperature", "heat_index", "ozone",
                    "respiratory_stress", "health_category")
            .orderBy("site_id", "date"))


@register("forecast_cards", with_ctes([FLOG, LATEST], f"""
SELECT forecast_date, forecast_horizon, predicted_category,
  strftime(forecast_date, '%a %d %b') AS day_label,
  COALESCE(CAST(CAST(round(confidence * 100, 0) AS INTEGER) AS VARCHAR) || '%', 'N/A') AS confidence_label,
  {_map_sql('predicted_category', FORECAST_ADVICE, FORECAST_ADVICE_DEFAULT)} AS advice
FROM latest ORDER BY forecast_date, forecast_horizon LIMIT 7"""))
def forecast_cards(spark, sf_dir):
    """W9 + F22: the seven forecast cards, from the deduplicated forecasts."""
    first7 = latest_forecast_df(spark, sf_dir).orderBy("forecast_date", "forecast_horizon").limit(7)
    return first7.select(
        "forecast_date", "forecast_horizon", "predicted_category",
        MT.card_label(F.col("forecast_date")).alias("day_label"),
        MT.percent_label(F.col("confidence")).alias("confidence_label"),
        mapping_lookup(F.col("predicted_category"), FORECAST_ADVICE,
                       FORECAST_ADVICE_DEFAULT).alias("advice"))


@register("category_lookup", with_ctes(GOLD_CHAIN[:2] + [JOINED, V1_FEAT] + GOLD_CHAIN[3:], f"""
SELECT g.site_id, g.date, g.health_category, m.model_category
FROM gold g LEFT JOIN (SELECT site_id, date, {v1_case()} AS model_category FROM v1) m
  ON m.site_id = g.site_id AND m.date = g.date"""))
def category_lookup(spark, sf_dir):
    """LOOKUPVALUE of another table's label by key, on a deduplicated key."""
    g = gold_features(spark, sf_dir)
    other = keep_last(health_category_v1(spark, sf_dir)
                      .select("site_id", "date", F.col("health_category").alias("model_category")),
                      ["site_id", "date"], ["model_category"])
    return g.join(other, ["site_id", "date"], "left").select(
        "site_id", "date", "health_category", "model_category")


__all__ = ["WD", "PD"]
