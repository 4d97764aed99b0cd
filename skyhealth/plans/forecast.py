"""Forecast feature engineering.

Daily forecast records from the two providers are joined on
(site, run, date, horizon); NULL or absent measures take baselines, four of
which are the run's own extremes (a window over one run: at most three rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyhealth.functions.columns import clip, ensure_columns, keep_existing
from skyhealth.functions.constants import FORECAST_BASELINE
from skyhealth.functions.features import heat_index, pollution_level, respiratory_stress
from skyhealth.schemas import FORECAST_FEATURE_COLUMNS
from skyhealth.sources.payloads import unwrap_days, wrap_days

RUN_KEYS = ["site_id", "run_date"]
# Baselines replaced by the run's own extreme of another measure.
RUN_SCOPED = {"temp_max": ("max", "temperature"), "temp_min": ("min", "temperature"),
              "humidity_max": ("max", "humidity"), "wind_max": ("max", "wind")}

WEATHER_DAY = T.StructType([T.StructField(n, t, True) for n, t in [
    ("date", T.StringType()), ("horizon", T.IntegerType()),
    ("temperature", T.DoubleType()), ("humidity", T.DoubleType()), ("wind", T.DoubleType()),
    ("pressure", T.DoubleType()), ("cloud_cover", T.DoubleType()),
    ("temp_max", T.DoubleType()), ("temp_min", T.DoubleType()),
    ("humidity_max", T.DoubleType()), ("humidity_min", T.DoubleType()),
    ("wind_max", T.DoubleType()), ("wind_gust_max", T.DoubleType()),
    ("apparent_temp_max", T.DoubleType()), ("precipitation", T.DoubleType()),
    ("source", T.StringType())]])


def land_and_reload(daily: DataFrame, fetched_at: Column, day_schema: T.StructType) -> DataFrame:
    """K2 then S6: serialise each run's days as ``{fetched_at, days[]}`` and
    read them back (the shape the forecast files are landed in)."""
    wrapped = wrap_days(daily, RUN_KEYS, fetched_at)
    return unwrap_days(wrapped, day_schema)


def join_forecasts(weather: DataFrame, pollution: DataFrame) -> DataFrame:
    """Inner join on (site, run, date, horizon). Emptiness is checked by
    the job wrapper (:func:`require_rows`), not inside the plan."""
    return weather.join(pollution, RUN_KEYS + ["date", "horizon"], "inner")


def baseline_fill(df: DataFrame) -> DataFrame:
    """F16 + J13: NULL or absent → baseline; run-scoped extremes for four measures."""
    w = Window.partitionBy(*RUN_KEYS)
    fills = {}
    for name, base in FORECAST_BASELINE.items():
        fallback: Column = F.lit(base)
        if name in RUN_SCOPED:
            fn, src = RUN_SCOPED[name]
            if src in df.columns:
                agg = F.max(src) if fn == "max" else F.min(src)
                fallback = agg.over(w)
        fills[name] = F.coalesce(F.col(name), fallback) if name in df.columns else fallback
    return df.withColumns(fills)


def engineer(weather: DataFrame, pollution: DataFrame, run_ts: Column | None = None) -> DataFrame:
    df = baseline_fill(join_forecasts(weather, pollution))
    df = ensure_columns(df, {c: (T.DoubleType(), None) for c in
                             ["temperature", "humidity", "wind", "pressure", "cloud_cover",
                              "sulphur_dioxide"]})
    c = F.col
    df = df.withColumns({
        "heat_index": heat_index(c("temperature"), c("humidity"), c("wind")),
        "pollution_level": pollution_level(c("pm25"), c("pm10"), c("aqi")),
        "respiratory_stress": respiratory_stress(c("pm25"), c("ozone"), c("nitrogen_dioxide"),
                                                 c("sulphur_dioxide")),
        "uv_risk": F.lit(0.0),
        "temp_range": c("temp_max") - c("temp_min"),
        "heat_stress_peak": c("apparent_temp_max"),
        "dust_risk_index": c("wind_max") * (F.lit(1) - c("humidity_min") / F.lit(100)),
        "rain_wash_effect": clip(c("precipitation"), 0.0, 20.0),
    })
    cols = list(FORECAST_FEATURE_COLUMNS)
    if run_ts is not None:
        df = df.withColumn("processed_at", run_ts)
        cols.append("processed_at")
    return keep_existing(df.withColumn("aqi", F.col("aqi").cast("double")), cols)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Job-level guard: raise when a required join produced no rows (one
    ``limit(1)`` probe, not a full count)."""
    if not df.limit(1).take(1):
        raise ValueError(f"{what} produced 0 rows")
    return df
