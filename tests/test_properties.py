"""Property and brute-force tests: rules against a plain-Python evaluation,
merge idempotence, calendar completeness."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyhealth.functions.columns import nan_to_null
from skyhealth.functions.rules import category_expr
from skyhealth.operators import gaps, merge
from skyhealth.plans.daily import gold_features

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _or(x, d):
    """Python truthiness: None/NaN handling as the day records see it."""
    if x is None:
        return d
    return x or d


def py_v21(r):
    """Plain-Python statement of the v2.1 rules (brute-force oracle)."""
    aqi, pm25 = _or(r["aqi"], 0), _or(r["pm25"], 0)
    ozone, no2 = _or(r["ozone"], 0), _or(r["nitrogen_dioxide"], 0)
    peak, dust_ri = _or(r["heat_stress_peak"], 0), _or(r["dust_risk_index"], 0)
    rain, wind_max = _or(r["rain_wash_effect"], 0), _or(r["wind_max"], 0)
    hum_min, aod, dust = _or(r["humidity_min"], 50), _or(r["aerosol_optical_depth"], 0), _or(r["dust"], 0)
    f = max(0.5, 1 - rain * 0.05)
    ea, ep = aqi * f, pm25 * f
    if (wind_max > 40 and hum_min < 20 and dust_ri > 25) or dust > 200 or (aod > 0.55 and wind_max > 35):
        return "Avoid Outdoor Activity Day"
    if ea > 150 or ep > 65:
        return "Avoid Outdoor Activity Day"
    if ea > 120 or ep > 50 or peak > 54:
        return "Mask Recommended Day"
    if ea > 90 or ep > 35 or ozone > 100 or dust_ri > 30 or aod > 0.40:
        return "High Respiratory Risk Day"
    if ea > 50 or ep > 12 or no2 > 40:
        return "Moderate Risk Day"
    return "Safe Air Day"


def test_v21_matches_brute_force_on_driver_rows(spark, sf_small):
    rows = gold_features(spark, sf_small).collect()
    assert rows
    mismatches = [r for r in rows if py_v21(r.asDict()) != r.health_category]
    assert not mismatches


MEASURE = st.one_of(st.none(), st.just(0.0), st.floats(0, 600, allow_nan=False), st.just(math.nan))
ROW = st.fixed_dictionaries({c: MEASURE for c in [
    "aqi", "pm25", "ozone", "nitrogen_dioxide", "heat_stress_peak", "dust_risk_index",
    "rain_wash_effect", "wind_max", "humidity_min", "aerosol_optical_depth", "dust"]})


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=12))
def test_v21_total_and_equal_to_python(spark, rows):
    cols = list(rows[0])
    df = nan_to_null(spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                           ", ".join(f"{c} double" for c in cols)))
    got = [r[0] for r in df.select(category_expr(df, "v2.1")).collect()]
    clean = [{c: (None if (v is not None and math.isnan(v)) else v) for c, v in r.items()} for r in rows]
    assert got == [py_v21(r) for r in clean]


KEYED = st.lists(st.tuples(st.integers(0, 2), st.integers(1, 20), st.floats(0, 100, allow_nan=False)),
                 min_size=0, max_size=15)


@SETTINGS
@given(KEYED, KEYED)
def test_insert_if_absent_and_upsert_idempotent(spark, a, b):
    schema = "site_id int, day int, v double"
    t = spark.createDataFrame(a, schema).dropDuplicates(["site_id", "day"])
    n = spark.createDataFrame(b, schema).dropDuplicates(["site_id", "day"])
    keys = ["site_id", "day"]
    once = merge.insert_if_absent(t, n, keys)
    twice = merge.insert_if_absent(once, n, keys)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    u1 = merge.upsert(t, n, keys)
    u2 = merge.upsert(u1, n, keys)
    assert sorted(map(tuple, u1.collect())) == sorted(map(tuple, u2.collect()))
    assert u1.count() == u1.select(*keys).distinct().count()


@SETTINGS
@given(st.sets(st.integers(0, 40), min_size=1, max_size=20),
       st.sets(st.integers(0, 40), min_size=1, max_size=20))
def test_missing_dates_complete_overlap(spark, wdays, pdays):
    base = dt.date(2024, 1, 1)
    w = spark.createDataFrame([(0, base + dt.timedelta(days=d)) for d in wdays], "site_id int, date date")
    p = spark.createDataFrame([(0, base + dt.timedelta(days=d)) for d in pdays], "site_id int, date date")
    lo, hi = max(min(wdays), min(pdays)), min(max(wdays), max(pdays))
    got = {(r.date - base).days for r in gaps.missing_dates(w, p).collect()}
    expected = {d for d in range(lo, hi + 1)} - set(pdays) if lo <= hi else set()
    assert got == expected


def test_latest_per_key_hot_key(spark):
    """A single key holding most rows reduces to one row (map-side max_by)."""
    rows = [(1, i, float(i)) for i in range(2000)] + [(2, 5, 5.0)]
    df = spark.createDataFrame(rows, "k int, seq int, v double").repartition(8)
    got = sorted(map(tuple, merge.latest_per_key(df, ["k"], ["seq"]).collect()))
    assert got == [(1, 1999, 1999.0), (2, 5, 5.0)]


__all__ = ["F"]
