"""The daily gold feature table: weather ⋈ air quality → indices → category.

One shuffle per input (the (site, date) partial aggregates) plus the join;
both join sides are already partitioned on (site_id, date) by their
aggregations, so the sort-merge join reuses that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyhealth.functions.columns import ensure_columns, nan_to_null
from skyhealth.functions.features import add_features
from skyhealth.functions.rules import classify
from skyhealth.schemas import (GOLD_COLUMNS, KEYS, POLLUTION_COLUMNS,
                               WEATHER_COLUMNS)
from skyhealth.sources.driver import pollution_daily, weather_daily


def join_daily(weather: DataFrame, pollution: DataFrame) -> DataFrame:
    """Inner equi-join on (site_id, date)."""
    return weather.join(pollution, KEYS, "inner")


def build_features(joined: DataFrame, profile: str = "v2.1",
                   source: str | None = None) -> DataFrame:
    """F1-F8 + rule label, conformed to the gold column order."""
    df = nan_to_null(joined)
    df = ensure_columns(df, {c: (T.DoubleType(), None)
                             for c in WEATHER_COLUMNS + POLLUTION_COLUMNS})
    df = add_features(df)
    df = classify(df, profile)
    df = df.withColumn("source", F.lit(source).cast("string"))
    return df.select(*GOLD_COLUMNS)


def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical gold table for the driver data (source NULL)."""
    return build_features(join_daily(weather_daily(spark, sf_dir),
                                     pollution_daily(spark, sf_dir)))
