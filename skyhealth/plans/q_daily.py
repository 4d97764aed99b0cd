"""Step 1: daily features and the v2.1 health category."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyhealth.functions.columns import zero_fill
from skyhealth.functions.rules import storm_column
from skyhealth.plans.daily import gold_features
from skyhealth.plans.oracle import GOLD_CHAIN, GOLD_COLS, with_ctes
from skyhealth.plans.registry import register
from skyhealth.session import scratch_path
from skyhealth.sources.tables import read_dated_csv, write_table


@register("daily_features", with_ctes(GOLD_CHAIN, f"SELECT {GOLD_COLS} FROM gold"))
def daily_features(spark, sf_dir):
    return gold_features(spark, sf_dir)


def health_category_daily_df(spark, sf_dir):
    g = gold_features(spark, sf_dir)
    return g.select("site_id", "date", "aqi", "pm25", "heat_stress_peak", "dust_risk_index",
                    "rain_wash_effect", storm_column(g).alias("storm"), "health_category")


@register("health_category_daily", with_ctes(GOLD_CHAIN, """
SELECT site_id, date, aqi, pm25, heat_stress_peak, dust_risk_index, rain_wash_effect,
  (COALESCE(NULLIF(wind_max, 0), 0) > 40 AND COALESCE(NULLIF(humidity_min, 0), 50) < 20
     AND COALESCE(NULLIF(dust_risk_index, 0), 0) > 25)
  OR COALESCE(NULLIF(dust, 0), 0) > 200
  OR (COALESCE(NULLIF(aerosol_optical_depth, 0), 0) > 0.55 AND COALESCE(NULLIF(wind_max, 0), 0) > 35)
  AS storm,
  health_category
FROM gold"""))
def health_category_daily(spark, sf_dir):
    return health_category_daily_df(spark, sf_dir)



@register("processed_features_csv", with_ctes(GOLD_CHAIN, f"SELECT {GOLD_COLS} FROM gold WHERE day(date) <> 13"))
def processed_features_csv(spark, sf_dir):
    """The processed feature file, read by header; rows whose date does
    not parse are dropped."""
    g = gold_features(spark, sf_dir)
    path = scratch_path(spark, f"features-csv-{uuid.uuid4().hex[:12]}")
    date = F.when(F.dayofmonth("date") == 13, F.lit("13th")).otherwise(F.date_format("date", "yyyy-MM-dd"))
    write_table(g.withColumn("date", date), path, "csv", options={"header": "true"})
    schema = T.StructType([T.StructField("date", T.StringType()) if f.name == "date" else f for f in g.schema])
    return read_dated_csv(spark, path, schema).select(*g.columns)


ABSENT = ["ozone", "uv_risk"]
FILLED = ["site_id", "date", "temperature", "pm25", *ABSENT, "rain_wash_effect"]


@register("absent_feature_fill", with_ctes(GOLD_CHAIN, """
SELECT site_id, date, COALESCE(temperature, 0) AS temperature, COALESCE(CASE WHEN day(date) <> 7 THEN pm25 END, 0) AS pm25,
  CAST(0 AS DOUBLE) AS ozone, CAST(0 AS DOUBLE) AS uv_risk, COALESCE(rain_wash_effect, 0) AS rain_wash_effect FROM gold"""))
def absent_feature_fill(spark, sf_dir):
    """A feature table that lacks two columns and some values; the
    scoring input has a 0 for each."""
    g = gold_features(spark, sf_dir).drop(*ABSENT)
    g = g.withColumn("pm25", F.when(F.dayofmonth("date") != 7, F.col("pm25")))
    return zero_fill(g, [c for c in FILLED if c not in ("site_id", "date")]).select(*FILLED)
