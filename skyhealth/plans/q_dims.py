"""Step 8: date dimension."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyhealth.functions.columns import stable_round
from skyhealth.operators.dims import date_attributes, dim_from_facts, dim_full_range
from skyhealth.operators.merge import missing_dimension_rows
from skyhealth.plans.daily import gold_features
from skyhealth.plans.oracle import GOLD_CHAIN, with_ctes
from skyhealth.plans.q_merge import FLOG
from skyhealth.plans.registry import register
from skyhealth.sources.driver import forecast_log


def attrs_sql(d: str = "date") -> str:
    return (f"{d} AS date, CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month, "
            f"strftime({d}, '%B') AS month_name, CAST(quarter({d}) AS INTEGER) AS quarter, "
            f"CAST(floor((dayofyear({d}) + dayofweek(date_trunc('year', {d})) + 1 - 2) / 7) + 1 AS INTEGER) AS week, "
            f"strftime({d}, '%A') AS day_of_week, dayofweek({d}) IN (0, 6) AS is_weekend")


DIM = f"""dim AS (SELECT {attrs_sql()} FROM (SELECT DISTINCT date FROM gold WHERE date IS NOT NULL) t)"""


@register("dim_date", with_ctes(GOLD_CHAIN + [DIM], "SELECT * FROM dim"))
def dim_date(spark, sf_dir):
    return dim_from_facts(gold_features(spark, sf_dir))


@register("dim_date_full_range", with_ctes(GOLD_CHAIN + [FLOG], f"""
SELECT {attrs_sql()} FROM (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (
    SELECT MIN(lo) AS lo, MAX(hi) AS hi FROM (
      SELECT MIN(date) AS lo, MAX(date) AS hi FROM gold
      UNION ALL SELECT MIN(forecast_date), MAX(forecast_date) FROM flog) b) s) c"""))
def dim_date_full_range(spark, sf_dir):
    fl = forecast_log(spark, sf_dir).select(F.col("forecast_date").alias("date"))
    return dim_full_range(gold_features(spark, sf_dir).select("date"), fl)


@register("orphan_dates", with_ctes(GOLD_CHAIN + [DIM, FLOG], """
SELECT DISTINCT forecast_date AS date FROM flog f
WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.date = f.forecast_date)"""))
def orphan_dates(spark, sf_dir):
    dim = dim_from_facts(gold_features(spark, sf_dir))
    fl = forecast_log(spark, sf_dir).select(F.col("forecast_date").alias("date"))
    return missing_dimension_rows(fl, dim)


@register("fact_by_weekend", with_ctes(GOLD_CHAIN + [DIM], """
SELECT d.is_weekend, d.day_of_week, COUNT(*) AS days, round_even(round_even(AVG(g.aqi), 10), 6) AS avg_aqi,
  COUNT(*) FILTER (WHERE g.health_category = 'Avoid Outdoor Activity Day') AS avoid_days
FROM gold g JOIN dim d ON g.date = d.date GROUP BY d.is_weekend, d.day_of_week"""))
def fact_by_weekend(spark, sf_dir):
    g = gold_features(spark, sf_dir)
    dim = dim_from_facts(g)          # one row per calendar day
    j = g.join(dim, ["date"], "inner")
    return (j.groupBy("is_weekend", "day_of_week")
            .agg(F.count(F.lit(1)).alias("days"),
                 stable_round(F.avg("aqi"), 6).alias("avg_aqi"),
                 F.count_if(F.col("health_category") == "Avoid Outdoor Activity Day")
                 .alias("avoid_days")))


__all__ = ["date_attributes"]
