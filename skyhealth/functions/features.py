"""Health indices (F1-F8, F14) as native column expressions.

Every function returns ``Column``s or a ``DataFrame -> DataFrame`` step, so
the arithmetic stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyhealth.functions.columns import clip, round_half_even
from skyhealth.functions.constants import LIVE_SOURCE


def _z(df: DataFrame, name: str, default: float = 0.0) -> Column:
    """``df[name].fillna(default)``, or the default when the column is absent."""
    if name in df.columns:
        return F.coalesce(F.col(name), F.lit(default))
    return F.lit(default)


def heat_index(t: Column, h: Column, w: Column) -> Column:
    """F1: T + 0.33 H - 0.70 W."""
    return t + F.lit(0.33) * h - F.lit(0.70) * w


def pollution_level(pm25: Column, pm10: Column, aqi: Column) -> Column:
    """F2: 0.5 pm25 + 0.3 pm10 + 0.2 aqi."""
    return pm25 * F.lit(0.5) + pm10 * F.lit(0.3) + aqi * F.lit(0.2)


def respiratory_stress(pm25: Column, o3: Column, no2: Column, so2: Column) -> Column:
    """0.4 pm25 + 0.3 O3 + 0.2 NO2 + 0.1 SO2."""
    return pm25 * F.lit(0.4) + o3 * F.lit(0.3) + no2 * F.lit(0.2) + so2 * F.lit(0.1)


def uv_risk(uv: Column) -> Column:
    """clip(uv / 11 * 100, 0, 100)."""
    return clip(uv / F.lit(11) * F.lit(100), 0.0, 100.0)


def add_features(df: DataFrame) -> DataFrame:
    """Historical (v2.1) feature set: NULL inputs count as 0 (F1-F8)."""
    z = lambda n: _z(df, n)
    out = {
        "heat_index": heat_index(z("temperature"), z("humidity"), z("wind")),
        "pollution_level": pollution_level(z("pm25"), z("pm10"), z("aqi")),
        "respiratory_stress": respiratory_stress(
            z("pm25"), z("ozone"), z("nitrogen_dioxide"), z("sulphur_dioxide")),
        "uv_risk": uv_risk(z("uv_index")) if "uv_index" in df.columns else F.lit(0.0),
        "temp_range": (z("temp_max") - z("temp_min"))
        if "temp_max" in df.columns and "temp_min" in df.columns else F.lit(0.0),
        # apparent_temp_max, or temp_max when that column is absent.
        "heat_stress_peak": z("apparent_temp_max") if "apparent_temp_max" in df.columns
        else z("temp_max"),
        # wind_max * (1 - humidity_min / 100).
        "dust_risk_index": (z("wind_max") * (F.lit(1) - z("humidity_min") / F.lit(100)))
        if "wind_max" in df.columns and "humidity_min" in df.columns else F.lit(0.0),
        # F8: clip(precipitation, 0, 20).
        "rain_wash_effect": clip(z("precipitation"), 0.0, 20.0)
        if "precipitation" in df.columns else F.lit(0.0),
    }
    return df.withColumns(out)


def add_features_v1(df: DataFrame) -> DataFrame:
    """First-generation features: temperature/humidity/wind are *not* zero-filled."""
    raw = lambda n: F.col(n) if n in df.columns else F.lit(0.0)
    z = lambda n: _z(df, n)
    out = {
        "heat_index": heat_index(raw("temperature"), raw("humidity"), raw("wind")),
        "pollution_level": pollution_level(z("pm25"), z("pm10"), z("aqi")),
        "respiratory_stress": respiratory_stress(
            z("pm25"), z("ozone"), z("nitrogen_dioxide"), z("sulphur_dioxide")),
    }
    if "uv_index" in df.columns:
        out["uv_risk"] = uv_risk(z("uv_index"))
    return df.withColumns(out)


def _truthy(c: Column) -> Column:
    """Python truthiness of a number: not NULL and not 0."""
    return c.isNotNull() & (c != F.lit(0))


def _or(c: Column, d: Column) -> Column:
    """Python ``c or d`` for numbers."""
    return F.when(_truthy(c), c).otherwise(d)


#: Inputs of a live row and what stands in for a missing or zero one: a number,
#: another input, or the heat index.
LIVE_INPUTS = {
    "temperature": 0.0, "humidity": 0.0, "wind": 0.0, "precipitation": 0.0,
    "pm25": 0.0, "pm10": 0.0, "aqi": 0.0, "ozone": 0.0, "nitrogen_dioxide": 0.0, "sulphur_dioxide": 0.0,
    "temp_max": "temperature", "temp_min": "temperature", "humidity_min": "humidity", "wind_max": "wind",
    "apparent_temp_max": "heat_index",
}
PLAIN, ROUNDED, NULL_ZERO, NULL_ZERO_ROUNDED = (False, False), (False, True), (True, False), (True, True)
#: Columns of a live row: name, what it is made of, and whether zero becomes
#: NULL (T12) and the value is rounded to 4 decimals.
LIVE_COLUMNS = [
    ("temperature", "temperature", ROUNDED), ("humidity", "humidity", ROUNDED), ("wind", "wind", ROUNDED),
    ("pressure", "pressure", PLAIN), ("cloud_cover", "cloud_cover", PLAIN),
    ("temp_max", "temp_max", NULL_ZERO_ROUNDED), ("temp_min", "temp_min", NULL_ZERO_ROUNDED), ("temp_range", "temp_range", ROUNDED),
    ("apparent_temp_max", "apparent_temp_max", ROUNDED), ("apparent_temp_min", "apparent_temp_min", PLAIN),
    ("apparent_temp_mean", "apparent_temp_mean", PLAIN), ("humidity_max", "humidity_max", PLAIN),
    ("humidity_min", "humidity_min", NULL_ZERO_ROUNDED), ("wind_max", "wind_max", NULL_ZERO_ROUNDED),
    ("wind_gust_max", "wind_gust_max", PLAIN), ("precipitation", "precipitation", ROUNDED),
    ("pm25", "pm25", PLAIN), ("pm10", "pm10", NULL_ZERO), ("aqi", "aqi", PLAIN), ("ozone", "ozone", NULL_ZERO),
    ("nitrogen_dioxide", "nitrogen_dioxide", NULL_ZERO), ("sulphur_dioxide", "sulphur_dioxide", NULL_ZERO),
    ("heat_index", "heat_index", ROUNDED), ("pollution_level", "pollution_level", ROUNDED),
    ("respiratory_stress", "respiratory_stress", ROUNDED), ("uv_risk", "uv_risk", PLAIN),
    ("heat_stress_peak", "apparent_temp_max", ROUNDED), ("dust_risk_index", "dust_risk", ROUNDED),
    ("rain_wash_effect", "rain_wash", ROUNDED), ("source", "source", PLAIN),
]


def live_features(df: DataFrame) -> DataFrame:
    """a live daily row from the day's weather and pollution record, as
    ``LIVE_INPUTS`` and ``LIVE_COLUMNS`` say."""
    def given(name):
        return F.col(name) if name in df.columns else F.lit(None).cast("double")

    v = {name: _or(given(name), F.lit(stand_in)) for name, stand_in in LIVE_INPUTS.items() if not isinstance(stand_in, str)}
    v["heat_index"] = heat_index(v["temperature"], v["humidity"], v["wind"])
    v |= {name: _or(given(name), v[other]) for name, other in LIVE_INPUTS.items() if isinstance(other, str)}
    v["temp_range"] = v["temp_max"] - v["temp_min"]
    v["pollution_level"] = pollution_level(v["pm25"], v["pm10"], v["aqi"])
    v["respiratory_stress"] = respiratory_stress(v["pm25"], v["ozone"], v["nitrogen_dioxide"], v["sulphur_dioxide"])
    v["uv_risk"] = F.lit(0.0)
    v["dust_risk"] = F.when(v["humidity_min"] < 100, v["wind_max"] * (F.lit(1) - v["humidity_min"] / F.lit(100))).otherwise(F.lit(0.0))
    v["rain_wash"] = F.least(v["precipitation"], F.lit(20.0))
    v["source"] = F.lit(LIVE_SOURCE)

    out = [F.col(c) for c in ("site_id", "date") if c in df.columns]
    for name, made_of, (null_zero, rounded) in LIVE_COLUMNS:
        value = v[made_of] if made_of in v else given(made_of)
        value = F.when(_truthy(value), value) if null_zero else value
        out.append((round_half_even(value, 4) if rounded else value).alias(name))
    return df.select(*out)
