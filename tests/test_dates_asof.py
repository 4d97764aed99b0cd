"""Date bitmaps against Python sets; the as-of record against a plain search."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyhealth.operators import gaps
from skyhealth.plans import marts
from skyhealth.sources.payloads import latest_record_asof

D = dt.date


@pytest.mark.parametrize("seed", [1, 2])
def test_bitmaps_are_sets_of_dates(spark, seed):
    rnd = random.Random(seed)
    start = {0: D(2000, 1, 1), 1: D(1969, 12, 1), 2: D(1900, 1, 1), 3: D(2020, 1, 1)}
    w = [(s, d0 + dt.timedelta(rnd.randrange(60))) for s, d0 in start.items() for _ in range(40)] + [(2, D(2090, 5, 5)), (0, None), (9, D(2000, 1, 1))]
    p = [(s, d0 + dt.timedelta(20 + rnd.randrange(60))) for s, d0 in start.items() if s != 3 for _ in range(40)] + [
        (2, D(2091, 5, 5)), (3, D(2030, 1, 1)), (8, D(2000, 1, 1))]
    a, b = (spark.createDataFrame(x, "site_id int, date date") for x in (w, p))
    ws, ps = ({s: {d for t, d in x if t == s and d} for s in {t for t, _ in x}} for x in (w, p))
    got = {(r.site_id, r.date) for r in gaps.common_dates(a, b).collect()}
    assert got == {(s, d) for s in ws.keys() & ps.keys() for d in ws[s] & ps[s]}
    want = {}
    for s in ws.keys() & ps.keys():
        lo, hi = max(min(ws[s]), min(ps[s])), min(max(ws[s]), max(ps[s]))
        want[s] = {lo + dt.timedelta(i) for i in range((hi - lo).days + 1)} - ps[s]
    missing = [(r.site_id, r.date) for r in gaps.missing_dates(a, b).collect()]
    assert sorted(missing) == sorted((s, d) for s, ds in want.items() for d in ds)
    for r in gaps.overlap_stats(a, b).collect():
        s = r.site_id
        assert (r.weather_dates, r.pollution_dates, r.common_dates) == (len(ws[s]), len(ps[s]), len(ws[s] & ps[s]))
        assert (r.weather_min, r.pollution_max, r.missing_days) == (min(ws[s]), max(ps[s]), len(want[s]))
    assert gaps.common_dates(a.limit(0), b).count() == 0


def test_bitmaps_are_what_is_shuffled(spark, capsys):
    df = spark.range(1000).selectExpr("1 AS site_id", "date_add(DATE'2020-01-01', CAST(id % 300 AS INT)) AS date")
    gaps.missing_dates(df, df).explain("simple")
    plan = capsys.readouterr().out
    assert "partial_bitmap_construct_agg" in plan and "LeftAnti" not in plan


def test_asof_of_one_site_with_many_records(spark):
    n = 100_000
    records = spark.range(n).selectExpr("7 AS site_id", "date_add(DATE'1700-01-01', CAST(id AS INT)) AS date", "id AS v").where("v % 97 < 3")
    calendar = spark.range(n + 50).selectExpr("7 AS site_id", "date_add(DATE'1699-12-20', CAST(id AS INT)) AS as_of")
    got = latest_record_asof(records, calendar, ["site_id"])
    # Day 11 of the calendar is day 0 of the records.
    i = F.datediff("as_of", F.lit("1700-01-01").cast("date"))
    last = F.least(i, F.lit(n - 1))
    want = F.when(F.pmod(last, F.lit(97)) < 3, last).otherwise(last - F.pmod(last, F.lit(97)) + 2)
    assert got.count() == n + 50 - 12 and got.where(F.col("v") != want).count() == 0
    assert got.where(F.datediff("file_date", F.lit("1700-01-01").cast("date")) != F.col("v")).count() == 0


def test_asof_ties_and_sites_without_records(spark):
    records = spark.createDataFrame([(1, D(2024, 1, 5), 3), (1, D(2024, 1, 5), 9), (1, None, 100), (None, D(2024, 1, 1), 4)], "site_id int, date date, v int")
    days = spark.createDataFrame([(1, D(2024, 1, 4)), (1, D(2024, 1, 5)), (1, D(2025, 6, 1)), (2, D(2024, 1, 5)), (None, D(2024, 3, 1))], "site_id int, as_of date")
    got = {(r.site_id, str(r.as_of)): (str(r.file_date), r.v) for r in latest_record_asof(records, days, ["site_id"]).collect()}
    assert got == {(1, "2024-01-05"): ("2024-01-05", 9), (1, "2025-06-01"): ("2024-01-05", 9), (None, "2024-03-01"): ("2024-01-01", 4)}


def test_presets_have_no_window(spark, capsys):
    df = spark.createDataFrame([(0, D(2024, 1, 1), 1.0), (0, D(2024, 1, 20), 3.0), (None, D(2024, 1, 1), 5.0)], "site_id int, date date, aqi double")
    out = marts.relative_windows(df, [7, 30])
    out.explain("simple")
    assert "Window" not in capsys.readouterr().out
    assert sorted((str(r.site_id), r.preset_days, r.days, r.avg_aqi) for r in out.collect()) == [
        ("0", 7, 1, 3.0), ("0", 30, 2, 2.0), ("None", 7, 1, 5.0), ("None", 30, 1, 5.0)]
