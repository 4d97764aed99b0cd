"""Step 9: latest-wins, purges and top-k."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyhealth.operators import merge as M
from skyhealth.operators.gaps import keep_last
from skyhealth.plans.daily import gold_features
from skyhealth.plans.oracle import GOLD_CHAIN, GOLD_COLS, with_ctes
from skyhealth.plans.q_merge import FKEYS, FLOG, FLOG_ORDER
from skyhealth.plans.registry import register
from skyhealth.schemas import GOLD_COLUMNS, LATEST_FORECAST_COLUMNS
from skyhealth.sources.driver import forecast_log

LATEST = """latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
    PARTITION BY forecast_date, forecast_horizon ORDER BY generated_at DESC, event_id DESC) AS rn
  FROM flog) t WHERE rn = 1)"""
LATEST_COLS = ", ".join(LATEST_FORECAST_COLUMNS)


def latest_forecast_df(spark, sf_dir):
    return M.latest_per_key(forecast_log(spark, sf_dir), FKEYS, FLOG_ORDER)


@register("latest_forecast", with_ctes([FLOG, LATEST], f"SELECT {LATEST_COLS} FROM latest"))
def latest_forecast(spark, sf_dir):
    return latest_forecast_df(spark, sf_dir).select(*LATEST_FORECAST_COLUMNS)


@register("purge_superseded", with_ctes([FLOG, LATEST], "SELECT * FROM latest"))
def purge_superseded(spark, sf_dir):
    log = forecast_log(spark, sf_dir)
    return M.purge_superseded(log, FKEYS, FLOG_ORDER).select(*log.columns)


@register("recent_predictions_top30", with_ctes(GOLD_CHAIN, """
SELECT site_id, date, health_category, aqi, pm25 FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY site_id ORDER BY date DESC) AS rn FROM gold) t
WHERE rn <= 30"""))
def recent_predictions_top30(spark, sf_dir):
    """W6 per site: row_number ≤ 30 is planned with a partial WindowGroupLimit
    before the shuffle, so each task ships at most 30 rows per site."""
    g = gold_features(spark, sf_dir)
    w = Window.partitionBy("site_id").orderBy(F.col("date").desc())
    return (g.withColumn("rn", F.row_number().over(w)).where("rn <= 30")
            .select("site_id", "date", "health_category", "aqi", "pm25"))


@register("top5_latest_rows", with_ctes(GOLD_CHAIN, """
SELECT site_id, date, source, temperature, aqi FROM gold ORDER BY date DESC, site_id DESC LIMIT 5"""))
def top5_latest_rows(spark, sf_dir):
    """TOP 5 by date (TakeOrderedAndProject)."""
    g = gold_features(spark, sf_dir)
    return (g.orderBy(F.col("date").desc(), F.col("site_id").desc()).limit(5)
            .select("site_id", "date", "source", "temperature", "aqi"))


@register("latest_row_per_site", with_ctes(GOLD_CHAIN, f"""
SELECT {GOLD_COLS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY site_id ORDER BY date DESC) AS rn
  FROM gold) t WHERE rn = 1"""))
def latest_row_per_site(spark, sf_dir):
    """``iloc[-1]`` after ORDER BY date, as a max_by aggregate per site."""
    return keep_last(gold_features(spark, sf_dir), ["site_id"], ["date"]).select(*GOLD_COLUMNS)


@register("first_forecasts", with_ctes([FLOG, LATEST], f"""
SELECT {LATEST_COLS} FROM latest ORDER BY forecast_date, forecast_horizon LIMIT 7"""))
def first_forecasts(spark, sf_dir):
    """First seven forecast rows by date (the 7 forecast cards)."""
    return (latest_forecast_df(spark, sf_dir)
            .orderBy("forecast_date", "forecast_horizon").limit(7)
            .select(*LATEST_FORECAST_COLUMNS))
