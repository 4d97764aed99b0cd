"""Intra-day slot roll-ups.

Plain ``groupBy(site, run, day)`` aggregates; partial aggregation means a
busy site/day never sits in one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyhealth.functions.aqi import pm25_to_us_aqi
from skyhealth.functions.columns import round_half_even
from skyhealth.functions.constants import FORECAST_AQI_WHEN_NO_PM25


def horizon(day: Column, as_of: Column) -> Column:
    """whole days from the run date to the slot day."""
    return F.datediff(day, as_of)


def forecast_window(slots: DataFrame, as_of: str = "run_date", lo: int = 1, hi: int = 3) -> DataFrame:
    """Keep slots whose day is ``lo..hi`` days after the run date."""
    return (slots.withColumn("horizon", horizon(F.col("date"), F.col(as_of)))
            .where(F.col("horizon").between(lo, hi)))


def same_day(slots: DataFrame, as_of: str = "run_date") -> DataFrame:
    """P10: today's slots only."""
    return slots.where(F.col("date") == F.col(as_of))


def _r4(c: Column) -> Column:
    return round_half_even(c, 4)


def weather_slots_to_daily(slots: DataFrame, keys=("site_id", "run_date")) -> DataFrame:
    """A1: 3-hourly weather slots → daily record per (keys, date, horizon)."""
    g = (slots.groupBy(*keys, "date", "horizon")
         .agg(_r4(F.avg("temp")).alias("temperature"),
              _r4(F.max("temp_max")).alias("temp_max"),
              _r4(F.min("temp_min")).alias("temp_min"),
              _r4(F.avg("humidity")).alias("humidity"),
              _r4(F.max("humidity")).alias("humidity_max"),
              _r4(F.min("humidity")).alias("humidity_min"),
              _r4(F.avg("wind")).alias("wind"),
              _r4(F.max("wind")).alias("wind_max"),
              _r4(F.max("wind_gust")).alias("wind_gust_max"),
              _r4(F.avg("pressure")).alias("pressure"),
              _r4(F.avg("cloud")).alias("cloud_cover"),
              _r4(F.sum("rain_3h")).alias("precipitation")))
    # Apparent max estimated from the rounded daily extremes.
    return g.withColumn("apparent_temp_max", _r4(
        F.col("temp_max") + F.lit(0.33) * F.col("humidity_max") - F.lit(0.70) * F.col("wind")))


def pollution_slots_to_daily(slots: DataFrame, keys=("site_id", "run_date")) -> DataFrame:
    """A2: hourly pollution slots → NULL-skipping daily means; AQI from the
    mean PM2.5 (F9), 90 when no PM2.5 at all."""
    g = (slots.groupBy(*keys, "date", "horizon")
         .agg(*[_r4(F.avg(c)).alias(c) for c in
                ["pm25", "pm10", "ozone", "nitrogen_dioxide", "sulphur_dioxide"]]))
    return g.withColumn("aqi", F.coalesce(pm25_to_us_aqi(F.col("pm25")),
                                          F.lit(FORECAST_AQI_WHEN_NO_PM25)))


def today_stats(slots: DataFrame, keys=("site_id", "run_date")) -> DataFrame:
    """A3: today's slot statistics; a run with no slot today yields no row."""
    return (same_day(slots).groupBy(*keys)
            .agg(F.max("temp").alias("temp_max"), F.min("temp").alias("temp_min"),
                 F.max("humidity").alias("humidity_max"), F.min("humidity").alias("humidity_min"),
                 F.max("wind").alias("wind_max"), F.max("wind_gust").alias("wind_gust_max"),
                 F.max("feels_like").alias("apparent_temp_max"),
                 F.min("feels_like").alias("apparent_temp_min"),
                 round_half_even(F.avg("feels_like"), 4).alias("apparent_temp_mean"),
                 F.sum("rain_3h").alias("precipitation"),
                 F.count(F.lit(1)).alias("n_slots")))
