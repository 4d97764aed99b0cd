"""Literal-row tests for AQI, rules, features, rounding and dates."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyhealth.functions.aqi import aqi_band_colour, pm25_to_us_aqi, severity
from skyhealth.functions.columns import nan_to_null, round_half_even
from skyhealth.functions.constants import AVOID, HIGH, MASK, MODERATE, SAFE
from skyhealth.functions.features import add_features, live_features
from skyhealth.functions.rules import category_expr
from skyhealth.operators.dims import date_attributes

MEASURES = ["aqi", "pm25", "ozone", "nitrogen_dioxide", "heat_index", "heat_stress_peak",
            "dust_risk_index", "rain_wash_effect", "wind_max", "humidity_min",
            "aerosol_optical_depth", "dust"]


def frame(spark, rows):
    """rows: list of dicts over MEASURES (missing → 0.0 unless given None)."""
    data = [tuple(float(r.get(c, 0.0)) if r.get(c, 0.0) is not None else None for c in MEASURES)
            for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} double" for c in MEASURES))


def labels(spark, rows, profile="v2.1"):
    df = nan_to_null(frame(spark, rows))
    return [r[0] for r in df.select(category_expr(df, profile)).collect()]


def test_aqi_breakpoints(spark):
    vals = [0.0, 12.0, 35.4, 55.4, 500.4, 12.05, -1.0, 600.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "pm25 double")
    got = [r[0] for r in df.select(pm25_to_us_aqi(F.col("pm25"))).collect()]
    assert got == [0, 50, 100, 150, 500, 500, 500, 500, None]


def test_aqi_band_colour_holes(spark):
    df = spark.createDataFrame([(10.0,), (50.5,), (None,)], "aqi double")
    got = [r[0] for r in df.select(aqi_band_colour(F.col("aqi"))).collect()]
    assert got == ["#2ecc71", "#95a5a6", "#95a5a6"]


def test_v21_thresholds(spark):
    got = labels(spark, [{"aqi": a} for a in (50, 50.1, 90, 90.1, 120.1, 150.1)])
    assert got == [SAFE, MODERATE, MODERATE, HIGH, MASK, AVOID]


def test_v21_rain_damping_and_storms(spark):
    got = labels(spark, [
        {"aqi": 160, "rain_wash_effect": 20},                         # 160 * 0.5 = 80
        {"dust": 201, "aqi": 10},                                      # raw dust storm
        {"wind_max": 41, "humidity_min": 19, "dust_risk_index": 26},  # storm A
        {"wind_max": 41, "humidity_min": 0, "dust_risk_index": 26},   # 0 → 50: no storm
        {"aqi": float("nan")},                                         # NaN must not be Avoid
        {"aerosol_optical_depth": 0.56, "wind_max": 36},               # AOD storm
    ])
    assert got == [MODERATE, AVOID, AVOID, SAFE, SAFE, AVOID]


def test_v1_thresholds(spark):
    got = labels(spark, [{"aqi": a} for a in (55, 55.1, 70.1, 85.1, 110.1)], "v1")
    assert got == [SAFE, MODERATE, HIGH, MASK, AVOID]


def test_live_profile_ignores_storm(spark):
    assert labels(spark, [{"dust": 500}, {"pm25": 12.5}], "live") == [SAFE, MODERATE]


def test_classifier_total_and_monotone_in_aqi(spark):
    order = [SAFE, MODERATE, HIGH, MASK, AVOID]
    aqis = [float(a) for a in range(0, 200, 3)]
    got = labels(spark, [{"aqi": a} for a in aqis])
    assert all(g in order for g in got)
    ranks = [order.index(g) for g in got]
    assert ranks == sorted(ranks)


def test_uv_risk_clip(spark):
    df = spark.createDataFrame([(5.5,), (22.0,), (None,)], "uv_index double")
    got = [r[0] for r in add_features(df).select("uv_risk").collect()]
    assert got == [50.0, 100.0, 0.0]


def test_features_zero_fill_and_defaults(spark):
    df = spark.createDataFrame([(None, 50.0, 10.0)], "temperature double, humidity double, wind double")
    r = add_features(df).collect()[0]
    assert math.isclose(r.heat_index, 0.33 * 50 - 0.70 * 10)
    assert r.temp_range == 0.0 and r.dust_risk_index == 0.0 and r.rain_wash_effect == 0.0


def test_live_features_zero_to_null(spark):
    df = spark.createDataFrame([(20.0, 40.0, 10.0, 0.0, 0.0, 30.0, 0.0)],
                               "temperature double, humidity double, wind double, pm10 double, "
                               "ozone double, pm25 double, humidity_min double")
    r = live_features(df).collect()[0]
    assert r.pm10 is None and r.ozone is None
    assert r.humidity_min == 40.0           # falls back to the mean
    assert r.source == "api_daily"


def test_round_half_even_matches_numpy(spark):
    vals = [0.00015, 2.675, -275.84815, 1.23456789, 0.5, 1.5, 2.5, -0.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even(F.col("x"), 4)).collect()]
    assert got == [float(np.round(v, 4)) for v in vals]


def test_severity_min(spark):
    df = spark.createDataFrame([(SAFE,), (MASK,)], "c string")
    assert df.select(F.min(severity(F.col("c")))).collect()[0][0] == 2


@pytest.mark.parametrize("d,week", [("2022-01-01", 1), ("2022-01-02", 2), ("2023-01-01", 1)])
def test_us_week(spark, d, week):
    df = spark.createDataFrame([(dt.date.fromisoformat(d),)], "date date")
    r = date_attributes(df).collect()[0]
    assert r.week == week


def test_weekend_flag(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 8),)], "date date")
    got = [(r.day_of_week, r.is_weekend) for r in date_attributes(df).collect()]
    assert got == [("Saturday", True), ("Monday", False)]


def test_measure_and_percent_labels(spark):
    from skyhealth.plans.marts import card_label, measure_label, percent_label
    df = spark.createDataFrame([(23.46, 0.873, dt.date(2026, 1, 5)), (None, None, dt.date(2026, 1, 6))],
                               "t double, c double, d date")
    got = [tuple(r) for r in df.select(measure_label(F.col("t"), "°C"), percent_label(F.col("c")),
                                       card_label(F.col("d"))).collect()]
    assert got == [("23.5 °C", "87%", "Mon 05 Jan"), ("N/A", "N/A", "Tue 06 Jan")]
