"""End-to-end daily jobs over a fresh warehouse folder; re-runs are idempotent."""

import datetime as dt
import io
import os
import tempfile
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from skyhealth.ml import risk_model as R
from skyhealth.plans import jobs as J
from skyhealth.plans.q_slots import pollution_forecast_daily, weather_forecast_daily
from skyhealth.schemas import GOLD_COLUMNS
from skyhealth.sources.driver import pollution_daily, pollution_raw, weather_daily, weather_raw


def _counts(spark, wh):
    return {name: spark.read.parquet(getattr(wh, name)).count()
            for name in ("features", "dim_date", "silver_weather", "silver_pollution",
                         "predictions", "forecasts")}


def test_daily_jobs_idempotent(spark, sf_small):
    wh = J.Warehouse(tempfile.mkdtemp(prefix="skyhealth-wh-"))
    run_ts = F.lit("2024-01-01 07:00:00").cast("timestamp")
    today_w = weather_daily(spark, sf_small).where(F.dayofmonth("date") == 1)
    today_p = pollution_daily(spark, sf_small).where(F.dayofmonth("date") == 1)

    def run_all():
        J.historical_load(spark, weather_raw(spark, sf_small), pollution_raw(spark, sf_small), wh)
        ef = spark.read.parquet(wh.features)
        model, feats, _ = R.train(ef.where(F.col("source").isNull()), num_trees=3, max_depth=4)
        J.append_live(spark, today_w, today_p, wh, model, feats, run_ts)
        J.score_new_days(spark, wh, model, feats, run_ts)
        J.forecast_run(spark, weather_forecast_daily(spark, sf_small),
                       pollution_forecast_daily(spark, sf_small), wh, model, feats, run_ts)

    run_all()
    first = _counts(spark, wh)
    run_all()
    assert _counts(spark, wh) == first
    ef = spark.read.parquet(wh.features)
    assert ef.where("source = 'api_daily'").count() > 0
    # every feature row has a prediction, every fact date a dimension row
    assert ef.select("site_id", "date").distinct().count() == first["predictions"]
    assert ef.select("date").distinct().join(spark.read.parquet(wh.dim_date), "date",
                                             "left_anti").count() == 0
    fc = spark.read.parquet(wh.forecasts)
    assert fc.groupBy("site_id", "forecast_date", "forecast_horizon").count() \
        .where("count > 1").count() == 0


def _files(root):
    return {os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def _gold(spark, rows):
    base = spark.createDataFrame(rows, "site_id int, date date, source string, aqi double")
    return base.select(*[F.col(c) if c in base.columns else F.lit(None).cast("double").alias(c) for c in GOLD_COLUMNS])


def test_a_daily_append_touches_only_its_month(spark, tmp_path):
    day = dt.date
    path = str(tmp_path / "gold")
    rows = [(s, day(2024, m, d), None, 1.0) for s in (0, 1) for m in (1, 2, 3) for d in (1, 2)] + [(0, day(2024, 3, 1), "api_daily", 2.0)]
    J.laid_out(_gold(spark, rows), live=True).write.partitionBy(*J.GOLD_LAYOUT).parquet(path)
    before = _files(path)
    today = J.laid_out(_gold(spark, [(0, day(2024, 3, 1), "api_daily", 9.0), (1, day(2024, 3, 5), "api_daily", 3.0)]), live=True)
    for _ in range(2):
        J.append_new(spark, today, path, ["site_id", "date", "source"], J.GOLD_LAYOUT)
    after = _files(path)
    assert {k: v for k, v in after.items() if k in before} == before
    assert {k.split("/part")[0] for k in after.keys() - before.keys()} == {"live=1/month=202403"}
    got = spark.read.parquet(path)
    assert got.count() == len(rows) + 1 and got.where("aqi = 9").count() == 0
    out = io.StringIO()
    with redirect_stdout(out):
        J.touched(got, today, J.GOLD_LAYOUT).explain("formatted")
    (scan,) = [x for x in out.getvalue().splitlines() if x.startswith("PartitionFilters")]
    assert "202403" in scan and "live" in scan


def test_a_refresh_leaves_live_files_alone(spark, tmp_path):
    day = dt.date
    path = str(tmp_path / "gold")
    old = [(0, day(2024, m, 1), s, 1.0) for m in (1, 2, 3) for s in (None, "csv", "api_daily")]
    J.laid_out(_gold(spark, old), live=True).write.partitionBy(*J.GOLD_LAYOUT).parquet(path)
    live = {k: v for k, v in _files(path).items() if k.startswith("live=1")}
    new = _gold(spark, [(0, day(2024, m, 1), None, 5.0) for m in (2, 4)])
    for _ in range(2):
        J.refresh_historical(new, path)
    got = sorted((r.month, r.source or "", r.aqi) for r in spark.read.parquet(path).collect())
    assert got == sorted([(m, "api_daily", 1.0) for m in (202401, 202402, 202403)] + [(202402, "", 5.0), (202404, "", 5.0)])
    assert {k: v for k, v in _files(path).items() if k.startswith("live=1")} == live
