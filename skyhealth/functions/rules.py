"""Rule-based daily health classifier (F10-F13) as a native ``when`` chain.

Rules are data: each profile is an ordered list of (category, conditions)
where a condition is (input, threshold) meaning ``input > threshold``. The
first matching tier wins; no match is Safe. Inputs follow Python ``x or d``
truthiness (T1): NULL and 0 fall back to the input's default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyhealth.functions.columns import or_default
from skyhealth.functions.constants import AVOID, HIGH, MASK, MODERATE, SAFE


@dataclass(frozen=True)
class RuleProfile:
    name: str
    tiers: list                    # [(category, [(input, threshold), ...]), ...]
    rain_damping: bool = False     # effective aqi/pm25 = x * max(.5, 1 - .05 rain)
    storm: bool = False            # storm detector (F13) -> Avoid first
    defaults: dict = field(default_factory=dict)


# ---------------------------------------------------------------- fixed values
# Tier thresholds per profile, worst tier first; "aqi"/"pm25" are the
# rain-damped values when the profile damps.
V21 = RuleProfile(
    name="v2.1",
    rain_damping=True,
    storm=True,
    defaults={"humidity_min": 50.0},
    tiers=[
        (AVOID, [("aqi", 150), ("pm25", 65)]),
        (MASK, [("aqi", 120), ("pm25", 50), ("heat_stress_peak", 54)]),
        (HIGH, [("aqi", 90), ("pm25", 35), ("ozone", 100), ("dust_risk_index", 30),
                ("aerosol_optical_depth", 0.40)]),
        (MODERATE, [("aqi", 50), ("pm25", 12), ("nitrogen_dioxide", 40)]),
    ],
)
V1 = RuleProfile(
    name="v1",
    tiers=[
        (AVOID, [("aqi", 110), ("pm25", 50)]),
        (MASK, [("aqi", 85), ("pm25", 30), ("heat_index", 48)]),
        (HIGH, [("aqi", 70), ("pm25", 20), ("ozone", 80)]),
        (MODERATE, [("aqi", 55), ("pm25", 14), ("nitrogen_dioxide", 30)]),
    ],
)
LIVE = RuleProfile(
    name="live",
    rain_damping=True,
    tiers=[
        (AVOID, [("aqi", 150), ("pm25", 65)]),
        (MASK, [("aqi", 120), ("pm25", 50)]),
        (HIGH, [("aqi", 90), ("pm25", 35)]),
        (MODERATE, [("aqi", 50), ("pm25", 12)]),
    ],
)
# Storm: (wind_max > 40 and humidity_min < 20 and dust_risk_index > 25)
#        or dust > 200 or (aerosol_optical_depth > 0.55 and wind_max > 35)
STORM_WIND_MAX = 40
STORM_HUMIDITY_MIN_BELOW = 20
STORM_DUST_RISK = 25
STORM_RAW_DUST = 200
STORM_AOD = 0.55
STORM_AOD_WIND_MAX = 35
RAIN_FACTOR_FLOOR = 0.5
RAIN_FACTOR_PER_MM = 0.05
# ---------------------------------------------------------- end fixed values

PROFILES = {p.name: p for p in (V21, V1, LIVE)}


def _inputs(df: DataFrame, profile: RuleProfile) -> dict:
    names = {n for _, conds in profile.tiers for n, _ in conds}
    names |= {"aqi", "pm25", "rain_wash_effect"}
    if profile.storm:
        names |= {"wind_max", "humidity_min", "dust_risk_index", "dust",
                  "aerosol_optical_depth"}
    vals = {}
    for n in names:
        src = F.col(n) if n in df.columns else F.lit(None).cast("double")
        vals[n] = or_default(src, profile.defaults.get(n, 0.0))
    return vals


def storm_flag(v: dict) -> Column:
    """F13 storm detector over already-defaulted inputs."""
    return (
        ((v["wind_max"] > STORM_WIND_MAX) & (v["humidity_min"] < STORM_HUMIDITY_MIN_BELOW)
         & (v["dust_risk_index"] > STORM_DUST_RISK))
        | (v["dust"] > STORM_RAW_DUST)
        | ((v["aerosol_optical_depth"] > STORM_AOD) & (v["wind_max"] > STORM_AOD_WIND_MAX))
    )


def category_expr(df: DataFrame, profile: str | RuleProfile = "v2.1",
                  inputs: dict | None = None) -> Column:
    """Column expression giving exactly one category per row."""
    p = PROFILES[profile] if isinstance(profile, str) else profile
    v = inputs if inputs is not None else _inputs(df, p)
    if p.rain_damping:
        factor = F.greatest(F.lit(RAIN_FACTOR_FLOOR),
                            F.lit(1) - v["rain_wash_effect"] * F.lit(RAIN_FACTOR_PER_MM))
        v = dict(v, aqi=v["aqi"] * factor, pm25=v["pm25"] * factor)
    expr = None
    if p.storm:
        expr = F.when(storm_flag(v), F.lit(AVOID))
    for category, conds in p.tiers:
        cond = None
        for name, thr in conds:
            term = v[name] > F.lit(thr)
            cond = term if cond is None else (cond | term)
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr.otherwise(F.lit(SAFE))


def classify(df: DataFrame, profile: str | RuleProfile = "v2.1",
             out: str = "health_category") -> DataFrame:
    """Add the category column.

    The defaulted rule inputs are projected once as columns and the CASE
    chain refers to them, which keeps the optimised expression small (the
    inputs are themselves feature expressions) and evaluates each once.
    """
    p = PROFILES[profile] if isinstance(profile, str) else profile
    v = _inputs(df, p)
    staged = df.withColumns({f"__rule_{n}": e for n, e in v.items()})
    cols = {n: F.col(f"__rule_{n}") for n in v}
    return (staged.withColumn(out, category_expr(staged, p, cols))
            .drop(*[f"__rule_{n}" for n in v]))


def storm_column(df: DataFrame) -> Column:
    return storm_flag(_inputs(df, V21))
