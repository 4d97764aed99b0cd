"""The daily jobs end to end, over warehouse tables.

* :func:`historical_load` — clean both sources, write the gap report, join,
  derive features and categories, refresh the gold table keeping live rows
  (K4), back-fill the date dimension (J7/K8) and append new silver rows (P17).
* :func:`append_live` — today's live rows: features, live category,
  insert-if-absent (K5); optionally score them (M7).
* :func:`score_new_days` — predictions for feature rows without one (J6, M5).
* :func:`forecast_run` — forecast features, scoring with probabilities (M6)
  and the MERGE into the forecast table (K6).

The feature table is partitioned by ``live`` (1: landed live rows) and
``month``, the others by ``month``. A refresh rewrites the historical
partitions and leaves the live files alone; an append compares its rows with
the months it touches and reads no others; so a daily run costs a day, whatever
the history. Re-running a job after a failure gives the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyhealth.functions.constants import MODEL_VERSION
from skyhealth.functions.features import live_features
from skyhealth.functions.rules import classify
from skyhealth.ml import risk_model as R
from skyhealth.operators import merge as M
from skyhealth.operators.clean import clean_pollution, clean_weather
from skyhealth.operators.dims import dim_from_facts
from skyhealth.operators.gaps import missing_dates
from skyhealth.plans.daily import build_features, join_daily
from skyhealth.plans.forecast import engineer, require_rows
from skyhealth.schemas import GOLD_COLUMNS, POLLUTION_COLUMNS, WEATHER_COLUMNS
from skyhealth.session import cut_lineage
from skyhealth.sources.tables import (month_of, read_if_exists, refresh_partitions, replace_partitions, write_if_not_empty,
                                      write_table)

KEYS = ["site_id", "date"]
FORECAST_KEYS = ["site_id", "forecast_date", "forecast_horizon"]


@dataclass(frozen=True)
class Warehouse:
    """Table locations under one root (a shared filesystem or object store)."""
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def features(self): return self.path("gold/environmental_features")      # noqa: E704
    @property
    def predictions(self): return self.path("gold/risk_predictions")         # noqa: E704
    @property
    def forecasts(self): return self.path("gold/forecast_predictions")       # noqa: E704
    @property
    def dim_date(self): return self.path("gold/dim_date")                    # noqa: E704
    @property
    def silver_weather(self): return self.path("silver/weather_metrics")     # noqa: E704
    @property
    def silver_pollution(self): return self.path("silver/pollution_metrics") # noqa: E704
    @property
    def missing(self): return self.path("staging/missing_pollution_dates")   # noqa: E704


GOLD_LAYOUT = ["live", "month"]


def laid_out(rows: DataFrame, live: bool = False) -> DataFrame:
    """Rows with their partition columns (``live`` only for the feature table)."""
    out = rows.withColumn("month", month_of())
    return out.withColumn("live", M.is_live().cast("int")) if live else out


def touched(table: DataFrame, rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The partitions of ``table`` that ``rows`` has values of: the months and
    sources of a run, a handful for a daily one, read as partition filters."""
    for c in partition_by:
        table = table.where(F.col(c).isin([r[0] for r in rows.select(c).distinct().collect()]))
    return table


def append_new(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Append the rows whose key the table lacks, reading only the
    partitions they are of; the rows that were new."""
    rows = cut_lineage(rows)
    current = read_if_exists(spark, path)
    new = rows if current is None else cut_lineage(
        M.rows_to_insert(rows, touched(current, rows, partition_by), [*keys, *partition_by]))
    write_table(new, path, mode="append", partition_by=partition_by)
    return new


def refresh_historical(gold: DataFrame, path: str) -> None:
    """K4: the historical partitions become ``gold``; live ones keep their files."""
    refresh_partitions(cut_lineage(laid_out(gold.select(*GOLD_COLUMNS), live=True)), path, GOLD_LAYOUT, "live=0/month=*")


def historical_load(spark: SparkSession, weather_raw: DataFrame, pollution_raw: DataFrame,
                    wh: Warehouse) -> None:
    # Cleaned inputs feed the gap report and the join: stage them once.
    weather = cut_lineage(clean_weather(weather_raw))
    pollution = cut_lineage(clean_pollution(pollution_raw))
    write_if_not_empty(missing_dates(weather, pollution), wh.missing, fmt="parquet")   # K3
    refresh_historical(build_features(join_daily(weather, pollution)), wh.features)    # K4
    ef = spark.read.parquet(wh.features)
    existing = read_if_exists(spark, wh.dim_date)
    write_table(dim_from_facts(ef, existing=existing), wh.dim_date, mode="append")     # J7/K8
    append_new(spark, laid_out(ef.select(*KEYS, *WEATHER_COLUMNS, "heat_index", "source")),
               wh.silver_weather, KEYS, ["month"])                                     # P17
    append_new(spark, laid_out(ef.select(*KEYS, *POLLUTION_COLUMNS, "pollution_level", "source")),
               wh.silver_pollution, KEYS, ["month"])


def _predictions(model, todo: DataFrame, features: Sequence[str], run_ts: Column | None) -> DataFrame:
    scored = R.score(model, todo.drop("health_category"), features, run_ts)
    return scored.select(*KEYS, *features, F.col("predicted_category").alias("health_category"),
                         "model_version", *(["predicted_at"] if run_ts is not None else []), month_of().alias("month"))


def append_live(spark: SparkSession, weather_today: DataFrame, pollution_today: DataFrame,
                wh: Warehouse, model=None, features=None, run_ts: Column | None = None) -> None:
    """Today's records (one row per site) → live feature rows (insert if absent)."""
    live = classify(live_features(join_daily(weather_today, pollution_today)), "live")
    live = live.select(*[F.col(c) if c in live.columns else F.lit(None).cast("double").alias(c)
                         for c in GOLD_COLUMNS])
    live = cut_lineage(laid_out(live, live=True))
    append_new(spark, live, wh.features, [*KEYS, "source"], GOLD_LAYOUT)               # K5
    if model is not None:
        append_new(spark, _predictions(model, live.drop(*GOLD_LAYOUT), features, run_ts),
                   wh.predictions, KEYS, ["month"])                                    # M7


def score_new_days(spark: SparkSession, wh: Warehouse, model, features,
                   run_ts: Column | None = None, months: Sequence[int] | None = None) -> None:
    """J6 → F17 → transform → append (M5). ``months`` (yyyymm) bounds a daily
    run to the months it has rows of, in both tables; without it all are swept."""
    ef = spark.read.parquet(wh.features).where(F.col("date").isNotNull())
    done = read_if_exists(spark, wh.predictions)
    if months is not None:
        ef = ef.where(F.col("month").isin(list(months)))
        done = None if done is None else done.where(F.col("month").isin(list(months)))
    todo = ef if done is None else M.rows_to_insert(ef, done, [*KEYS, "month"])
    write_table(_predictions(model, todo.drop(*GOLD_LAYOUT), features, run_ts), wh.predictions, mode="append",
                partition_by=["month"])


def forecast_run(spark: SparkSession, weather_fc: DataFrame, pollution_fc: DataFrame,
                 wh: Warehouse, model, features, run_ts: Column,
                 model_version: str = MODEL_VERSION) -> None:
    """Forecast features → scored probabilities → MERGE on (site, date, horizon) (K6)."""
    ff = require_rows(engineer(weather_fc, pollution_fc, run_ts), "the joined forecasts")
    scored = R.score(model, ff, features, model_version=model_version)
    rows = scored.select(
        "site_id", F.col("date").alias("forecast_date"),
        F.col("horizon").cast("int").alias("forecast_horizon"),
        run_ts.alias("generated_at"), "model_version", "predicted_category", "confidence",
        "prob_safe", "prob_moderate", "prob_high_resp", "prob_mask", "prob_avoid",
        *[c for c in ff.columns if c not in ("site_id", "run_date", "date", "horizon",
                                             "processed_at")])
    # Only the months that the run has days of are read and rewritten.
    rows = cut_lineage(rows.withColumn("month", F.year("forecast_date") * 100 + F.month("forecast_date")))
    current = read_if_exists(spark, wh.forecasts)
    if current is not None:
        touched = current.join(rows.select("month").distinct(), "month", "left_semi")
        rows = M.upsert(touched, rows, [*FORECAST_KEYS, "month"], ["generated_at"])
    replace_partitions(rows, wh.forecasts, ["month"])
