"""Operator tests on tiny literal frames: merges, gaps, slots, payloads, quality."""

import datetime as dt
import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from skyhealth.operators import gaps, merge, slots
from skyhealth.operators.clean import clean_pollution, median_fill, typed_conversion
from skyhealth.operators.quality import classification_report, confusion, duplicate_keys
from skyhealth.schemas import HOURLY_COLUMNAR_PAYLOAD, WEATHER_SLOTS_PAYLOAD
from skyhealth.sources import payloads as P

D = dt.date


def test_partial_refresh_keeps_live_only(spark):
    cur = spark.createDataFrame([(0, D(2024, 1, 1), None, 1.0), (0, D(2024, 1, 2), "csv", 2.0),
                                 (0, D(2024, 1, 3), "api_daily", 3.0)],
                                "site_id int, date date, source string, aqi double")
    new = spark.createDataFrame([(0, D(2024, 1, 1), None, 10.0), (0, D(2024, 1, 2), None, 20.0)],
                                "site_id int, date date, source string, aqi double")
    got = sorted((r.date.day, r.source, r.aqi) for r in merge.partial_refresh(cur, new).collect())
    assert got == [(1, None, 10.0), (2, None, 20.0), (3, "api_daily", 3.0)]


def test_insert_if_absent_idempotent(spark):
    tgt = spark.createDataFrame([(0, D(2024, 1, 1), 1.0)], "site_id int, date date, v double")
    new = spark.createDataFrame([(0, D(2024, 1, 1), 9.0), (0, D(2024, 1, 2), 2.0)],
                                "site_id int, date date, v double")
    once = merge.insert_if_absent(tgt, new, ["site_id", "date"])
    twice = merge.insert_if_absent(once, new, ["site_id", "date"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert sorted((r.date.day, r.v) for r in twice.collect()) == [(1, 1.0), (2, 2.0)]


def test_upsert_same_key_twice(spark):
    tgt = spark.createDataFrame([(D(2024, 1, 2), 1, "a", 0), (D(2024, 1, 3), 1, "b", 0)],
                                "forecast_date date, forecast_horizon int, cat string, seq int")
    upd = spark.createDataFrame([(D(2024, 1, 2), 1, "x", 1), (D(2024, 1, 2), 1, "y", 2)],
                                "forecast_date date, forecast_horizon int, cat string, seq int")
    got = sorted((r.forecast_date.day, r.cat) for r in
                 merge.upsert(tgt, upd, ["forecast_date", "forecast_horizon"], ["seq"]).collect())
    assert got == [(2, "y"), (3, "b")]


def test_latest_forecast_newest_wins(spark):
    log = spark.createDataFrame(
        [(D(2024, 1, 2), 1, dt.datetime(2024, 1, 1, 6), 1, "old"),
         (D(2024, 1, 2), 1, dt.datetime(2024, 1, 1, 9), 2, "new")],
        "forecast_date date, forecast_horizon int, generated_at timestamp, event_id long, cat string")
    got = merge.latest_per_key(log, ["forecast_date", "forecast_horizon"],
                               ["generated_at", "event_id"]).collect()
    assert [r.cat for r in got] == ["new"]


def test_delete_where_null_predicate_keeps_row(spark):
    df = spark.createDataFrame([(None,), ("api_daily",), ("csv",)], "source string")
    got = sorted(str(r.source) for r in merge.delete_where(df, F.col("source") == "api_daily").collect())
    assert got == ["None", "csv"]


def test_gap_chunks_65_dates(spark):
    days = [(0, D(2020, 1, 1) + dt.timedelta(days=2 * i)) for i in range(65)]
    df = spark.createDataFrame(days, "site_id int, date date")
    got = sorted(r.n_days for r in gaps.chunk_dates(df).collect())
    assert got == [5, 30, 30]


def test_missing_dates_complete_the_calendar(spark):
    w = spark.createDataFrame([(0, D(2024, 1, d)) for d in range(1, 11)], "site_id int, date date")
    p = spark.createDataFrame([(0, D(2024, 1, d)) for d in (2, 3, 7, 9)], "site_id int, date date")
    miss = gaps.missing_dates(w, p)
    got = sorted(r.date.day for r in miss.collect())
    assert got == [4, 5, 6, 8]                       # overlap is Jan 2 .. Jan 9
    both = sorted(r.date.day for r in miss.unionByName(p).collect())
    assert both == list(range(2, 10))


def test_median_fill_per_site(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (0, None), (1, 10.0), (1, None)],
                               "site_id int, x double")
    got = sorted((r.site_id, r.x) for r in median_fill(df, ["x"]).collect())
    assert got == [(0, 1.0), (0, 2.0), (0, 3.0), (1, 10.0), (1, 10.0)]


def test_clean_pollution_drops_bad_dates_and_dedupes(spark):
    raw = spark.createDataFrame([(0, "2022-08-01", 10.0, 50.0), (0, "2022-08-01", 10.0, 50.0),
                                 (0, "not a date", 11.0, 60.0), (0, "2022-08-02", None, 70.0)],
                                "site_id int, date string, pm2_5 double, us_aqi double")
    got = sorted((str(r.date), r.pm25, r.aqi) for r in clean_pollution(raw).collect())
    assert got == [("2022-08-01", 10.0, 50.0), ("2022-08-02", 10.0, 70.0)]


def test_typed_conversion_rejects(spark):
    raw = spark.createDataFrame([("1", "2.5"), ("2", "n/a"), ("3", None)], "id string, v string")
    typed, rej = typed_conversion(raw, {"v": "double"}, "id")
    assert [(r.id, r.raw_value) for r in rej.collect()] == [("2", "n/a")]
    assert sorted(str(r.v) for r in typed.collect()) == ["2.5", "None", "None"]


def test_horizon_filter(spark):
    df = spark.createDataFrame([(D(2024, 1, 1 + k), D(2024, 1, 1)) for k in (0, 1, 3, 4)],
                               "date date, run_date date")
    got = sorted(r.horizon for r in slots.forecast_window(df).collect())
    assert got == [1, 3]


def _write_json(docs):
    d = tempfile.mkdtemp(prefix="skyhealth-test-")
    with open(os.path.join(d, "payload.json"), "w") as f:
        for doc in docs:
            f.write(json.dumps(doc) + "\n")
    return d


def test_weather_slot_payload_and_daily(spark):
    day1 = 1704153600  # 2024-01-02 00:00 UTC
    doc = {"site_id": 0, "run_date": "2024-01-01", "list": [
        {"dt": day1, "main": {"temp": 10.0, "humidity": 50.0, "pressure": 1000.0},
         "wind": {"speed": 10.0}, "clouds": {"all": 20.0}},
        {"dt": day1 + 3 * 3600, "main": {"temp": 20.0, "temp_max": 22.0, "humidity": 70.0,
                                         "pressure": 1002.0},
         "wind": {"speed": 5.0, "gust": 20.0}, "clouds": {"all": 40.0}, "rain": {"3h": 1.5}}]}
    path = _write_json([doc])
    rows = P.explode_weather_slots(P.read_json(spark, path, WEATHER_SLOTS_PAYLOAD, multiline=False))
    daily = slots.weather_slots_to_daily(slots.forecast_window(rows)).collect()
    assert len(daily) == 1
    r = daily[0]
    assert r.horizon == 1 and r.temperature == 15.0 and r.temp_max == 22.0 and r.temp_min == 10.0
    assert r.wind == 27.0 and r.wind_max == 36.0 and r.wind_gust_max == 72.0
    assert r.precipitation == 1.5
    assert r.apparent_temp_max == round(22.0 + 0.33 * 70.0 - 0.70 * 27.0, 4)


def test_hourly_columnar_payload(spark):
    doc = {"site_id": 1, "batch_seq": 1, "hourly": {
        "time": ["2024-01-01T00:00", "2024-01-01T01:00"], "pm2_5": [10.0, 20.0],
        "us_aqi": [40.0, 60.0]}}
    empty = {"site_id": 2, "batch_seq": 1}
    path = _write_json([doc, empty])
    rows = P.explode_hourly_columnar(P.read_json(spark, path, HOURLY_COLUMNAR_PAYLOAD,
                                                 multiline=False))
    daily = gaps.hourly_to_daily(rows, ["pm2_5", "us_aqi"]).collect()
    assert [(r.site_id, r.pm25, r.aqi) for r in daily] == [(1, 15.0, 50.0)]


def test_wrap_unwrap_round_trip(spark):
    from skyhealth.plans.forecast import WEATHER_DAY, land_and_reload
    daily = spark.createDataFrame([(0, D(2024, 1, 1), D(2024, 1, 2), 1, 20.0)],
                                  "site_id int, run_date date, date date, horizon int, temperature double")
    back = land_and_reload(daily, F.lit("2024-01-01T00:00:00Z"), WEATHER_DAY).collect()
    assert [(r.date, r.horizon, r.temperature) for r in back] == [(D(2024, 1, 2), 1, 20.0)]


def test_classification_report_from_confusion(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")], "t string, p string")
    rep = {r.label: r for r in classification_report(confusion(df, "t", "p")).collect()}
    assert rep["a"].precision == 1.0 and rep["a"].recall == 0.5
    assert rep["accuracy"].f1_score == 0.75 and rep["weighted avg"].support == 4


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(0, D(2024, 1, 1)), (0, D(2024, 1, 1)), (0, D(2024, 1, 2))],
                               "site_id int, date date")
    assert [(r.date.day, r.n) for r in duplicate_keys(df, ["site_id", "date"]).collect()] == [(1, 2)]


def test_replace_table_reads_itself(spark):
    from skyhealth.sources.tables import replace_table, write_if_not_empty
    base = tempfile.mkdtemp(prefix="skyhealth-table-")
    path = os.path.join(base, "features")
    spark.createDataFrame([(0, D(2024, 1, 1), None), (0, D(2024, 1, 2), "api_daily")],
                          "site_id int, date date, source string").write.parquet(path)
    current = spark.read.parquet(path)
    new = spark.createDataFrame([(0, D(2024, 1, 1), None)], "site_id int, date date, source string")
    replace_table(spark, merge.partial_refresh(current, new), path, keep_old=True)
    got = sorted((r.date.day, r.source) for r in spark.read.parquet(path).collect())
    assert got == [(1, None), (2, "api_daily")]
    empty = spark.createDataFrame([], "date date")
    assert write_if_not_empty(empty, os.path.join(base, "missing")) is False


def test_csv_is_read_by_header(spark):
    from skyhealth.sources.tables import read_weather_csv
    d = tempfile.mkdtemp(prefix="skyhealth-csv-")
    with open(os.path.join(d, "w.csv"), "w") as f:
        f.write("relative_humidity_2m_mean,date,temperature_2m_mean,unknown\n50,2020-01-01 00:00:00+00:00,10.5,x\n"
                "n/a,2020-01-02 00:00:00+00:00,,y\n")
    a, b = read_weather_csv(spark, d).orderBy("date").collect()
    assert (a.date, a.temperature_2m_mean, a.relative_humidity_2m_mean, a.site_id) == ("2020-01-01 00:00:00+00:00", 10.5, 50.0, None)
    assert b.temperature_2m_mean is None and b.relative_humidity_2m_mean is None


def test_upsert_keeps_columns_the_update_lacks(spark):
    from skyhealth.operators.merge import upsert
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "stay")], "k int, v string, extra string")
    updates = spark.createDataFrame([(1, "new"), (3, "c")], "k int, v string")
    got = sorted(tuple(r) for r in upsert(target, updates, ["k"]).select("k", "v", "extra").collect())
    assert got == [(1, "new", "keep"), (2, "b", "stay"), (3, "c", None)]


def test_failed_swap_leaves_the_old_table(spark, monkeypatch):
    from skyhealth.sources import tables
    path = os.path.join(tempfile.mkdtemp(prefix="skyhealth-swap-"), "t")
    tables.write_table(spark.range(3), path)
    monkeypatch.setattr(tables, "write_table", lambda *a, **k: None)      # nothing gets staged
    with pytest.raises(Exception):
        tables.replace_table(spark, spark.range(5), path)
    assert spark.read.parquet(path).count() == 3


def test_partitions_replaced_are_only_those_touched(spark):
    from skyhealth.sources.tables import replace_partitions
    path = os.path.join(tempfile.mkdtemp(prefix="skyhealth-parts-"), "t")
    replace_partitions(spark.createDataFrame([(1, 10), (2, 20)], "m int, v int"), path, ["m"])
    current = spark.read.parquet(path)
    replace_partitions(current.where("m = 2").selectExpr("m", "v + 1 AS v"), path, ["m"])
    assert sorted((r.m, r.v) for r in spark.read.parquet(path).collect()) == [(1, 10), (2, 21)]


def test_stream_rollup_append_waits_for_watermark(spark):
    from skyhealth.streaming.rollup import run_rollup
    d = tempfile.mkdtemp(prefix="skyhealth-stream-")
    rows = [(i, dt.datetime(2024, 1, 1 + i // 4, i % 24), i % 10, "purchase" if i % 2 else "click",
             float(i), json.dumps({"k": i})) for i in range(40)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                "value double, props string").coalesce(1).write.parquet(
        os.path.join(d, "events_landing"))
    src = os.path.join(d, "events_landing")
    complete = spark.read.parquet(run_rollup(spark, src, max_files=1))
    append = spark.read.parquet(run_rollup(spark, src, mode="append", watermark="2 days"))
    assert complete.agg(F.sum("n_slots")).collect()[0][0] == 40
    # append mode withholds the days the watermark has not passed yet
    assert append.count() < complete.count()
    assert append.join(complete, ["date", "site_id", "n_slots"], "left_anti").count() == 0


def test_latest_landed_record_by_file_date(spark):
    from pyspark.sql import types as T
    d = tempfile.mkdtemp(prefix="skyhealth-landing-")
    for day, aqi in (("20240101", 10), ("20240103", 30), ("20240105", 50)):
        with open(os.path.join(d, f"pollution_api_{day}.json"), "w") as f:
            f.write(json.dumps({"site_id": 0, "aqi": aqi}) + "\n")
    schema = T.StructType([T.StructField("site_id", T.IntegerType()), T.StructField("aqi", T.IntegerType())])
    pick = lambda as_of: P.latest_landed_record(spark, os.path.join(d, "pollution_api_*.json"),
                                                schema, as_of).collect()[0]
    assert pick("2024-01-03").aqi == 30          # exact-date file
    assert pick("2024-01-04").aqi == 30          # else the latest earlier file
    assert str(pick("2024-01-09").file_date) == "2024-01-05"


def test_median_fill_approximate_and_global(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (0, 5.0), (0, None), (1, 7.0), (1, None)],
                               "site_id int, x double")
    approx = sorted((r.site_id, r.x) for r in median_fill(df, ["x"], approximate=True).collect())
    assert approx == [(0, 1.0), (0, 3.0), (0, 3.0), (0, 5.0), (1, 7.0), (1, 7.0)]
    glob = sorted(r.x for r in median_fill(df.drop("site_id"), ["x"], keys=()).collect())
    assert glob == [1.0, 3.0, 4.0, 4.0, 5.0, 7.0]        # global median of 1, 3, 5, 7


def test_stream_insert_if_absent_replay_safe(spark):
    from skyhealth.streaming.rollup import daily_events, run_insert_if_absent
    d = tempfile.mkdtemp(prefix="skyhealth-x2-")
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3, i % 24), i % 2, "click", 1.0, json.dumps({"k": i}))
            for i in range(30)]
    src = os.path.join(d, "landing")
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                "value double, props string").coalesce(1).write.parquet(src)
    target = os.path.join(d, "table")
    for _ in range(3):                                        # re-runs of the same files
        run_insert_if_absent(spark, src, target)
    out = daily_events(spark.read.parquet(target))
    assert out.count() == out.select("site_id", "date").distinct().count() == 6
    assert out.agg(F.sum("n_events")).collect()[0][0] == 30


def test_stream_insert_if_absent_keeps_late_events(spark, sf_small):
    """Half of the events land, then the other half, of the same days; both replayed."""
    from skyhealth.streaming.rollup import daily_events, run_insert_if_absent
    d = tempfile.mkdtemp(prefix="skyhealth-late-")
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    half = F.pmod(F.col("event_id"), F.lit(2)) == 0
    first, second, target = (os.path.join(d, x) for x in ("first", "second", "table"))
    events.where(half).write.parquet(first)
    events.where(~half).repartition(3).write.parquet(second)
    for src in (first, second, first, second):
        run_insert_if_absent(spark, src, target, max_files=1)
    got = daily_events(spark.read.parquet(target))
    assert got.agg(F.sum("n_events")).first()[0] == events.count()
