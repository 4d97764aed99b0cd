"""AQI conversion and banding (F9, F23, J11, J12, F24) as native expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyhealth.functions.constants import (AQI_NO_BAND_COLOUR, AQI_OUT_OF_SCALE,
                                           AQI_SCALE, PM25_AQI_BREAKPOINTS,
                                           SEVERITY, SEVERITY_UNKNOWN)


def pm25_to_us_aqi(pm25: Column, breakpoints: Sequence = PM25_AQI_BREAKPOINTS) -> Column:
    """piecewise-linear EPA interpolation, rounded half-even to int.

    First band with lo <= pm25 <= hi wins; NULL stays NULL; anything in no
    band (holes, negatives, > 500.4) is 500 (T4).
    """
    expr = None
    for lo, hi, a_lo, a_hi in breakpoints:
        cond = (pm25 >= F.lit(lo)) & (pm25 <= F.lit(hi))
        val = (F.lit(float(a_hi - a_lo)) / F.lit(hi - lo)) * (pm25 - F.lit(lo)) + F.lit(float(a_lo))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    rounded = F.bround(expr.otherwise(F.lit(float(AQI_OUT_OF_SCALE))), 0).cast("int")
    return F.when(pm25.isNull(), F.lit(None).cast("int")).otherwise(rounded)


def band_lookup(value: Column, bands: Sequence, pick: int, default) -> Column:
    """First band (lo, hi, ...) with lo <= value <= hi; ``pick`` selects the payload."""
    expr = None
    for band in bands:
        cond = (value >= F.lit(band[0])) & (value <= F.lit(band[1]))
        expr = F.when(cond, F.lit(band[pick])) if expr is None else expr.when(cond, F.lit(band[pick]))
    return expr.otherwise(F.lit(default))


def aqi_band_name(aqi: Column) -> Column:
    return band_lookup(aqi, AQI_SCALE, 3, "Unknown")


def aqi_band_colour(aqi: Column) -> Column:
    """colour of the AQI band, grey when between integer bands or NULL."""
    return band_lookup(aqi, AQI_SCALE, 2, AQI_NO_BAND_COLOUR)


def mapping_lookup(key: Column, mapping: Mapping, default) -> Column:
    """Equi lookup on a small constant dimension with a default."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default) if default is not None else F.lit(None))


def severity(category: Column) -> Column:
    """Severity of a category (1 = worst, 6 = unknown)."""
    return mapping_lookup(category, SEVERITY, SEVERITY_UNKNOWN)
